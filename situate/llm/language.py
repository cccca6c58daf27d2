"""Language identification by nearest centroids.

A text is the normalised TF-IDF vector of its byte trigrams (lower-cased Latin letters, other ASCII as
blanks) hashed to ``DIMS`` dimensions. Each language has ``CENTROIDS`` unit centroids, clustered by
cosine; the nearest centroid over all languages names a text's language, its cosine is the score. A text
farther from it than nearly all sample texts of the language are (the ``RADIUS`` quantile) is flagged as
rejected: the prediction is then the best guess only.

``train`` counts document frequencies over all training rows and clusters at most ``SAMPLE`` texts of
each language (the first by a hash of their id; whole texts). Prediction is one narrow scan of the text
alone; the model's size is fixed by the number of languages.

Null texts, empty ones and those without a letter are ``und`` with score 0. Rows of null language aren't
learnt; with none to learn from every text is ``und``. Ties go to the first language by name. Repeated
rows are predicted alike; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from situate.llm import textnum as X

DIMS = 1 << 13
CENTROIDS, SAMPLE, ROUNDS = 4, 400, 12
RADIUS = 0.995
UNKNOWN = "und"

ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True
PLAIN = np.full(256, 32, np.uint8)
PLAIN[128:] = np.arange(128, 256, dtype=np.uint8)
PLAIN[97:123] = np.arange(97, 123, dtype=np.uint8)
PLAIN[65:91] = np.arange(97, 123, dtype=np.uint8)


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, dimension, count) of the distinct trigram dimensions of each text, ordered by text."""
    low = PLAIN[data]
    upper = (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)
    low[1:][upper] += 0x20  # capital Latin letters of two bytes
    n = len(low) - 2
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    wide = low.astype(np.int64)
    key = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    at = np.flatnonzero(key != 0x202020)
    text = np.searchsorted(off, at, side="right") - 1
    inside = at + 3 <= off[text + 1]
    at, text = at[inside], text[inside]
    dim = (X._finish(key[at].astype(np.uint64)) >> np.uint64(51)).astype(np.int64)
    both, count = np.unique(text * DIMS + dim, return_counts=True)
    return both // DIMS, both % DIMS, count


def vectors(data: np.ndarray, off: np.ndarray, idf: np.ndarray):
    """Sparse unit vectors: (text, dimension, weight, where each text's begin)."""
    text, dim, count = trigrams(data, off)
    w = (np.log1p(count) * idf[dim]).astype(np.float32)
    begin = np.searchsorted(text, np.arange(len(off)))
    norm = np.sqrt(np.bincount(text, weights=w.astype(np.float64) ** 2, minlength=len(off) - 1))
    return text, dim, w / np.maximum(norm[text], 1e-12).astype(np.float32), begin


def cosines(text: np.ndarray, dim: np.ndarray, w: np.ndarray, begin: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """[texts, centroids] for centroids given as [dimensions, centroids]."""
    out = np.zeros((len(begin) - 1, centroids.shape[1]), np.float32)
    some = np.flatnonzero(np.diff(begin))
    if len(some):
        out[some] = np.add.reduceat(centroids[dim] * w[:, None], begin[some], axis=0)
    return out


def _cluster(text, dim, w, begin, rows: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids [dimensions, k] of the rows by spherical k-means, and the rows' cosines to theirs."""
    size = np.diff(begin)[rows]
    at = X.ragged(begin[rows], size)
    local, d, v = np.repeat(np.arange(len(rows)), size), dim[at], w[at]
    own = np.append(0, np.cumsum(size))
    k = min(CENTROIDS, len(rows))
    label = rng.permutation(np.arange(len(rows)) % k)
    for _ in range(ROUNDS):
        c = np.zeros((DIMS, k), np.float32)
        np.add.at(c, (d, label[local]), v)
        c /= np.maximum(np.linalg.norm(c, axis=0), 1e-12)
        cos = cosines(local, d, v, own, c)
        new = cos.argmax(axis=1)
        if (new == label).all():
            break
        label = new
    return c, cos.max(axis=1)


def _frequencies(batches):
    df = np.zeros(DIMS, np.int64)
    for _, data, off in X.chunks(batches, "text"):
        _, dim, _ = trigrams(data, off)
        df += np.bincount(dim, minlength=DIMS)
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some], pa.int64())], names=["dim", "n"])


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, seed: int = 5) -> dict:
    """A model from the rows given (filter them to the training rows first)."""
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    total = rows.count()
    df = np.zeros(DIMS, np.int64)
    for r in rows.select("text").mapInArrow(_frequencies, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect():
        df[r["dim"]] = r["n"]
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + np.float32(0.05)
    few = rows.select("id", "lang", F.xxhash64("id").alias("h"))
    for by in (("lang", F.pmod("h", F.lit(64))), ("lang",)):  # a language with most rows is first cut down in 64 parts
        first = Window.partitionBy(*by).orderBy("h", "id")
        few = few.withColumn("k", F.row_number().over(first)).where(F.col("k") <= sample).drop("k")
    few = few.select("id").distinct()  # at most ``sample`` ids a language
    some = rows.join(F.broadcast(few), "id").groupBy("id", "lang").agg(F.min("text").alias("text"))  # one text of a repeated id
    got = sorted((r["lang"], r["id"], r["text"]) for r in some.collect())
    data, off = X.utf8(pa.array([r[2] for r in got], pa.string()))
    text, dim, w, begin = vectors(data, off, idf)
    rng, names, parts, radius = np.random.default_rng(seed), [], [], {}
    langs = np.array([r[0] for r in got], object)
    for lang in sorted(set(langs.tolist())):
        own = np.flatnonzero((langs == lang) & (np.diff(begin) > 0))
        if len(own):
            c, cos = _cluster(text, dim, w, begin, own, rng)
            parts.append(c)
            names += [lang] * c.shape[1]
            radius[lang] = float(np.quantile(1 - cos, RADIUS))
    return {"idf": idf, "names": names, "radius": radius, "centroids": np.concatenate(parts, axis=1) if parts else np.zeros((DIMS, 0), np.float32)}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected per document row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        names = np.array([*m["names"], UNKNOWN], object)
        radius = np.array([*[m["radius"][n] for n in m["names"]], 0.0])
        for batch, data, off in X.chunks(batches, "text"):
            letters = np.append(0, np.cumsum(ASCII_LETTER[data]))[off]
            known = np.diff(letters) > 0
            raw = data.tobytes()
            for i in np.flatnonzero(~known & (np.diff(off) > 0)):
                known[i] = any(c.isalpha() for c in raw[off[i]:off[i + 1]].decode())
            if m["names"]:
                cos = cosines(*vectors(data, off, m["idf"]), m["centroids"])
                best, score = cos.argmax(axis=1), np.clip(cos.max(axis=1), 0, 1).astype(np.float64)
            else:
                best, score = np.zeros(len(known), np.int64), np.zeros(len(known))
            best = np.where(known, best, len(names) - 1) if m["names"] else np.full(len(known), len(names) - 1)
            score = np.where(known, score, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64()),
                                              pa.array((1 - score > radius[best]) | ~known, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ident = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {ident}, lang_pred string, score double, rejected boolean")
