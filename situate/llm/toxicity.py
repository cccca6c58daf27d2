"""Toxicity scores: a bidirectional gated recurrent network with attention pooling.

Words ([^\\x20\\x09-\\x0D]+ after lower-casing A-Z) enter as a hashed word vector beside the mean of their
hashed byte-trigram vectors. Two gated recurrent layers read windows of ``WIDTH`` words, which start every
``STRIDE`` words over the whole text; attention pools a window's states into a logit, and a text scores as
its worst window, put through a logistic calibration.

``train`` learns in numpy on the driver from at most ``SAMPLE`` labelled documents of each label (the
first in the order of a hash of their id; their whole texts): one pass in which a toxic document's
windows all count as toxic, then passes
that take each document's worst window (and other windows of clean documents), at least ``PASSES`` of
them and ``LEAST_STEPS`` steps. Scoring reads no
label, language, source or id and runs as one narrow scan: no shuffle, whatever the sizes of groups.

Null, empty and blank texts score as the least score any window can be given a document for: the
calibrated prior. An empty table scores nothing; with no labelled rows, or one label only, all scores
are that label's share (0 if none). Repeated rows score alike, and one text of a repeated id is learnt. Extra columns are ignored; a label other
than 0 and 1 or null is not learnt.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate.llm import textnum as X

SAMPLE = 1500
WIDTH, STRIDE = 32, 16
WORD_BITS, GRAM_BITS, DIM, HIDDEN = 17, 13, 8, 8
THRESHOLD = 0.3
BATCH = 256
PASSES = 10
DECAY, WORD_RATE = 1e-4, 4.0
LEAST_STEPS = 200


# ---- words -----------------------------------------------------------------------------------------

def vocabulary(data: np.ndarray, off: np.ndarray):
    """(first word of each text, distinct word of each word, hashes, trigram ids, where each word's begin)."""
    low, starts, ends, first, hashes = X.words(data, off, X.NON_SPACE)
    distinct, one, which = np.unique(hashes, return_index=True, return_inverse=True)
    before, after = np.empty(len(low), np.int64), np.empty(len(low), np.int64)
    before[1:], after[:-1] = low[:-1], low[1:]
    before[starts], after[ends - 1] = 1, 2
    s, size = starts[one], ends[one] - starts[one]
    at = X.ragged(s, size)
    grams = (before[at] << 16) | (low[at].astype(np.int64) << 8) | after[at]
    grams = (X._finish(grams.astype(np.uint64)) >> np.uint64(64 - GRAM_BITS)).astype(np.int32)
    return first, which, distinct, grams, np.append(0, np.cumsum(size))


def window_starts(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of all windows of all texts that have words."""
    count = np.diff(first)
    some = np.flatnonzero(count)
    number = 1 + np.maximum(0, -(-(count[some] - WIDTH) // STRIDE))
    text = np.repeat(some, number)
    order = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    at = first[text] + order * STRIDE
    return text, at, np.minimum(at + WIDTH, first[text + 1])


# ---- network ---------------------------------------------------------------------------------------

def new_model(seed: int = 7) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    f = lambda *shape, scale: (g.standard_normal(shape) * scale).astype(np.float32)
    m = {"word": np.zeros((1 << WORD_BITS, DIM), np.float32), "gram": f(1 << GRAM_BITS, DIM, scale=0.3),
         "v": f(2 * HIDDEN, scale=0.1), "w": f(2 * HIDDEN, scale=0.3), "b": np.zeros(1, np.float32)}
    for d in ("f", "r"):
        m["in" + d] = f(2 * DIM, 3 * HIDDEN, scale=0.4)
        m["bias" + d] = np.zeros(3 * HIDDEN, np.float32)
        m["u" + d] = f(HIDDEN, 3 * HIDDEN, scale=0.3)
    return m


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def embed(m: dict, hashes: np.ndarray, grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Vectors of distinct words."""
    out = np.empty((len(hashes), 2 * DIM), np.float32)
    out[:, :DIM] = m["word"][(hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
    if len(hashes):
        out[:, DIM:] = np.add.reduceat(m["gram"][grams], begin[:-1], axis=0) / np.diff(begin)[:, None]
    return out


def _layer(x, u, alive=None, keep=False):
    """States [T, B, H] of one recurrent layer over projected inputs [T, B, 3H]."""
    T, B, _ = x.shape
    h, out, kept = np.zeros((B, HIDDEN), np.float32), np.empty((T, B, HIDDEN), np.float32), []
    for t in range(T):
        a = h @ u
        zr = _sigmoid(x[t, :, :2 * HIDDEN] + a[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(x[t, :, 2 * HIDDEN:] + r * a[:, 2 * HIDDEN:])
        before, h = h, n + z * (h - n)
        if alive is not None:
            h = h * alive[t][:, None]
        out[t] = h
        if keep:
            kept.append((before, z, r, n, a[:, 2 * HIDDEN:]))
    return out, kept


def _layer_back(dout, kept, u, alive=None):
    """Gradients of the inputs and of u from those of the states."""
    T, B, _ = dout.shape
    dx, du, dh = np.empty((T, B, 3 * HIDDEN), np.float32), np.zeros_like(u), np.zeros((B, HIDDEN), np.float32)
    for t in range(T - 1, -1, -1):
        before, z, r, n, an = kept[t]
        dh = dh + dout[t]
        if alive is not None:
            dh = dh * alive[t][:, None]
        dn, dz = dh * (1 - z) * (1 - n * n), dh * (before - n) * z * (1 - z)
        da = np.concatenate([dz, dn * an * r * (1 - r), dn * r], axis=1)
        dx[t] = np.concatenate([da[:, :2 * HIDDEN], dn], axis=1)
        du += before.T @ da
        dh = dh * z + da @ u.T
    return dx, du


def logits(m: dict, table: np.ndarray, index: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Window logits; table: both projections of distinct words (the last row is padding), index [T, B]."""
    H3 = 3 * HIDDEN
    hf, _ = _layer(table[:, :H3][index], m["uf"])
    hr, _ = _layer(table[:, H3:][index[::-1]], m["ur"], alive[::-1])
    hr = hr[::-1]
    e = hf @ m["v"][:HIDDEN] + hr @ m["v"][HIDDEN:]
    e = np.where(alive > 0, e, np.float32(-1e9))
    p = np.exp(e - e.max(axis=0))
    p /= p.sum(axis=0)
    s = hf @ m["w"][:HIDDEN] + hr @ m["w"][HIDDEN:]
    return (p * s).sum(axis=0) + m["b"][0]


def project(m: dict, vectors: np.ndarray) -> np.ndarray:
    both = vectors @ np.concatenate([m["inf"], m["inr"]], axis=1) + np.concatenate([m["biasf"], m["biasr"]])
    return np.concatenate([both, np.zeros((1, 6 * HIDDEN), np.float32)])


def window_logits(m: dict, table: np.ndarray, which: np.ndarray, at: np.ndarray, end: np.ndarray, size: int = 2048) -> np.ndarray:
    out, step = np.empty(len(at), np.float32), np.arange(WIDTH)[:, None]
    padded = np.append(which, np.full(WIDTH, len(table) - 1))
    for i in range(0, len(at), size):
        a, e = at[i:i + size], end[i:i + size]
        T = int((e - a).max())
        index = a[None, :] + step[:T]
        alive = index < e[None, :]
        out[i:i + size] = logits(m, table, np.where(alive, padded[index], len(table) - 1), alive.astype(np.float32))
    return out


def text_logits(m: dict, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Each text's worst window; NaN where it has no word."""
    out = np.full(len(off) - 1, np.nan, np.float32)
    first, which, hashes, grams, begin = vocabulary(data, off)
    if len(which):
        text, at, end = window_starts(first)
        score = window_logits(m, project(m, embed(m, hashes, grams, begin)), which, at, end)
        head = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        out[text[head]] = np.maximum.reduceat(score, head)
    return out


# ---- training --------------------------------------------------------------------------------------

class _Trainer:
    """Adam over window batches."""

    def __init__(self, hashes, grams, begin, rate: float = 0.01):
        self.m = new_model()
        self.hashes, self.grams, self.begin, self.rate, self.t, self.spread = hashes, grams, begin, rate, 0, 0.0
        self.bucket = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        self.one = {k: np.zeros_like(v) for k, v in self.m.items()}
        self.two = {k: np.zeros_like(v) for k, v in self.m.items()}

    def step(self, index, alive, label, weight):
        """index [T, B] of distinct words (-1: padding)."""
        m, H, H3 = self.m, HIDDEN, 3 * HIDDEN
        words, local = np.unique(index, return_inverse=True)
        local = local.reshape(index.shape)
        pad = words[0] == -1
        words = words[1:] if pad else words
        local = np.where(index < 0, len(words), local - pad)
        size = self.begin[words + 1] - self.begin[words]
        ids = self.grams[X.ragged(self.begin[words], size)]
        own = np.append(0, np.cumsum(size))
        vec = embed(m, self.hashes[words], ids, own)
        table = project(m, vec)
        xf, xr = table[:, :H3][local], table[:, H3:][local[::-1]]
        hf, kf = _layer(xf, m["uf"], keep=True)
        hr_, kr = _layer(xr, m["ur"], alive[::-1], keep=True)
        u = np.concatenate([hf, hr_[::-1]], axis=2)
        e = np.where(alive > 0, u @ m["v"], np.float32(-1e9))
        p = np.exp(e - e.max(axis=0))
        p /= p.sum(axis=0)
        s = u @ m["w"]
        out = (p * s).sum(axis=0)
        y = _sigmoid(out + m["b"][0])
        d = ((y - label) * weight / len(label)).astype(np.float32)
        dp = p * d
        de = dp * (s - out)
        du = dp[:, :, None] * m["w"] + de[:, :, None] * m["v"]
        g = {"w": np.einsum("tb,tbh->h", dp, u), "v": np.einsum("tb,tbh->h", de, u), "b": d.sum(keepdims=True)}
        dxf, g["uf"] = _layer_back(du[:, :, :H], kf, m["uf"])
        dxr, g["ur"] = _layer_back(du[::-1, :, H:], kr, m["ur"], alive[::-1])
        dtable = np.zeros_like(table)
        np.add.at(dtable[:, :H3], local, dxf)
        np.add.at(dtable[:, H3:], local[::-1], dxr)
        dtable = dtable[:-1]
        g["inf"], g["inr"] = vec.T @ dtable[:, :H3], vec.T @ dtable[:, H3:]
        g["biasf"], g["biasr"] = dtable[:, :H3].sum(axis=0), dtable[:, H3:].sum(axis=0)
        dvec = dtable[:, :H3] @ m["inf"].T + dtable[:, H3:] @ m["inr"].T
        rows, place = np.unique(self.bucket[words], return_inverse=True)
        g["word"], g["gram"] = m["word"][rows] * np.float32(DECAY), np.zeros_like(m["gram"])
        np.add.at(g["word"], place, dvec[:, :DIM])
        np.add.at(g["gram"], ids, np.repeat(dvec[:, DIM:] / size[:, None], size, axis=0))
        self.t += 1
        # word vectors share one scale, so a rare word moves by its evidence only
        v = g.pop("word")
        self.spread = 0.99 * self.spread + 0.01 * float((v * v).sum(axis=1).max())
        m["word"][rows] -= self.rate * v / (np.sqrt(self.spread / (1 - 0.99 ** self.t)) + 1e-8) * np.float32(WORD_RATE)
        for k, v in g.items():
            self.one[k] += 0.1 * (v - self.one[k])
            self.two[k] += 0.001 * (v * v - self.two[k])
            m[k] -= self.rate * (self.one[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.two[k] / (1 - 0.999 ** self.t)) + 1e-8)


def fit(texts: list[str], label: np.ndarray, share: float, passes: int = PASSES, seed: int = 7) -> dict:
    """A model from whole texts and 0/1 labels; ``share``: the labels' true share of 1."""
    label = np.asarray(label, np.float32)
    if not len(label) or label.min() == label.max():
        return {"constant": float(label.mean()) if len(label) else 0.0}
    rng = np.random.default_rng(seed)
    parts, base = [], 0
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    for _, data, off in X.chunks([batch], "text"):
        first, which, hashes, grams, begin = vocabulary(data, off)
        text, at, end = window_starts(first)
        parts.append((hashes[which], text + base, at, end, hashes, grams, begin, len(which)))
        base += len(off) - 1
    every = np.concatenate([p[4] for p in parts])
    hashes, one = np.unique(every, return_index=True)
    size = np.concatenate([np.diff(p[6]) for p in parts])
    begin = np.append(0, np.cumsum(size))
    grams = np.concatenate([p[5] for p in parts])[X.ragged(begin[one], size[one])]
    begin = np.append(0, np.cumsum(size[one]))
    shift = np.cumsum([0] + [p[7] for p in parts])
    which = np.searchsorted(hashes, np.concatenate([p[0] for p in parts]))
    text = np.concatenate([p[1] for p in parts])
    at = np.concatenate([p[2] + s for p, s in zip(parts, shift)])
    end = np.concatenate([p[3] + s for p, s in zip(parts, shift)])
    trainer = _Trainer(hashes, grams, begin)
    step = np.arange(WIDTH)[:, None]
    padded = np.append(which, np.full(WIDTH, -1))

    def learn(rows):
        rows = rng.permutation(rows)
        for i in range(0, len(rows), BATCH):
            r = rows[i:i + BATCH]
            index = at[r][None, :] + step
            alive = index < end[r][None, :]
            y = label[text[r]]
            weight = np.where(y > 0, 0.5 / max(y.mean(), 0.05), 0.5 / max(1 - y.mean(), 0.05))
            trainer.step(np.where(alive, padded[index], -1), alive.astype(np.float32), y, weight)

    windows_1, windows_0 = np.flatnonzero(label[text] > 0), np.flatnonzero(label[text] == 0)
    if not len(windows_1) or not len(windows_0):  # texts of one label have no words: nothing to tell apart
        return {"constant": float(share)}
    while trainer.t < LEAST_STEPS // 2:
        learn(np.concatenate([windows_1, rng.choice(windows_0, min(len(windows_0), len(windows_1)), replace=False)]))
    head = np.flatnonzero(np.append(True, text[1:] != text[:-1]))

    def worst():
        m = trainer.m
        score = window_logits(m, project(m, embed(m, hashes, grams, begin)), which, at, end)
        top = np.maximum.reduceat(score, head)
        row = np.flatnonzero(score == np.repeat(top, np.diff(np.append(head, len(score)))))
        return top, row[np.append(True, text[row][1:] != text[row][:-1])]

    begun, k = trainer.t, 0
    while k < passes or trainer.t - begun < LEAST_STEPS:
        trainer.rate, k = (0.01 if k < passes // 2 else 0.004), k + 1
        _, rows = worst()
        learn(np.concatenate([rows, rng.choice(windows_0, min(len(windows_0), 2 * len(rows)), replace=False)]))
    top, _ = worst()
    y = label[text[head]]
    weight = np.where(y > 0, share / max(label.mean(), 1e-9), (1 - share) / max(1 - label.mean(), 1e-9))
    a, b = 1.0, 0.0
    for _ in range(100):  # Newton steps of a logistic fit, slightly held to slope 1
        p = 1 / (1 + np.exp(-np.clip(a * top + b, -30, 30)))
        r, s = weight * (p - y), weight * p * (1 - p)
        grad = np.array([(r * top).sum() + (a - 1), r.sum()])
        hess = np.array([[(s * top * top).sum() + 1, (s * top).sum()], [(s * top).sum(), s.sum() + 1e-6]])
        da, db = np.linalg.solve(hess, grad)
        a, b = a - da, b - db
    return {**trainer.m, "scale": (float(max(a, 1e-3)), float(b)), "none": float(min(share, 0.05))}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> dict:
    """A model from the labelled documents given (filter them to the training rows first)."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))  # an id counts once; with both labels it is toxic
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = []
    for y in (0, 1):
        chosen += [(r["doc_id"], y) for r in known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()]
    spark = docs.sparkSession
    few = spark.createDataFrame(chosen, "id long, y int")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(few), "id")
    rows = rows.groupBy("id", "y").agg(F.min("text").alias("text")).collect()  # one text an id, however often it is repeated
    rows = sorted((r["id"], r["text"] or "", r["y"]) for r in rows)
    return fit([r[1] for r in rows], np.array([r[2] for r in rows]), counts.get(1, 0) / max(1, sum(counts.values())))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
          keep_text: bool = False) -> DataFrame:
    """doc_id, score, predicted per document row, and the ``keep`` columns (not doc_id, text or score);
    with ``keep_text`` also text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch, data, off in X.chunks(batches, "text"):
            if "constant" in m:
                p = np.full(len(off) - 1, m["constant"])
            else:
                a, b = m["scale"]
                x = text_logits(m, data, off).astype(np.float64)
                p = np.where(np.isnan(x), m["none"], 1 / (1 + np.exp(-np.clip(a * np.nan_to_num(x) + b, -50, 50))))
            others = [c for c in batch.schema.names if keep_text or c != "text"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + [pa.array(p, pa.float64())], names=[*others, "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), *[F.col(k) for k in keep], F.col(text_col).alias("text"))
    schema = (rows if keep_text else rows.drop("text")).withColumn("score", F.lit(0.0)).schema
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
