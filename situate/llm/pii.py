"""Personal data: base patterns, and information-theoretic sanitisation of the terms around them.

Base spans (e-mail, IP, card and phone numbers) are protected entities. A term is a word (digits, letters,
characters beyond ASCII; lower-cased A-Z) outside all base spans; every term of a document is a candidate for every entity of
that document, however far apart they stand. Corpus co-occurrence tells how much
a candidate t reveals an entity e: with N documents, n(e), n(t) and n(t, e) of them holding e, t and both,

    PMI(t; e) = ln(n(t, e) N / (n(t) n(e)))        IC(e) = ln(N / n(e))

and t is disclosed, so generalised or removed wherever it stands in a document that holds e, when n(t, e) >=
``SUPPORT`` and PMI(t; e) >= ``ALPHA`` * IC(e). Documents without an entity are left alone.

Counts cover all documents, whole. Pairs stay distributed; the only broadcasts are Bloom filters of
``BLOOM_BITS`` positions over entities, pairs and terms, which spare rows that can't be disclosed: pairs of entities in fewer than
``SUPPORT`` documents, terms in more documents than any of their pairs allows (exactly counted and joined after).
A hot entity or term only ever meets sums. Null text is empty; repeated rows count and report each by
itself; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate.llm import textnum as X
from situate.session import materialize, scratch_path

KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT, ALPHA = 2, 0.9
BLOOM_BITS = 1 << 24

DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(rb"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")


def _lut(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


DIGIT = _lut(b"0123456789")
MAILISH = _lut(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-@")


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, bytes]]:
    """(text, start, kind, end, entity) of all base spans, in bytes of the chunk, in order."""
    n, found = len(data), []
    if not n:
        return found
    raw = data.tobytes()
    digit = DIGIT[data]
    edge = np.zeros(n, bool)
    full = np.flatnonzero(np.diff(off))
    edge[off[:-1][full]] = edge[off[1:][full] - 1] = True
    between = np.zeros(n, bool)
    between[1:-1] = digit[:-2] & digit[2:]
    between &= ~edge
    text_of = lambda at: int(np.searchsorted(off, at, side="right")) - 1

    if (at := np.flatnonzero(data == 64)).size:
        starts, ends, _ = X.mask_spans(MAILISH[data], off)
        after = 0  # the local part is all that stands before its @, after the last @ and the last match
        for a, k in zip(at.tolist(), (np.searchsorted(starts, at, side="right") - 1).tolist()):
            begin, after = max(int(starts[k]), after), a + 1
            if begin < a and (m := DOMAIN.match(raw, a + 1, int(ends[k]))):
                after = m.end()
                found.append((text_of(begin), begin, 0, after, b"0" + raw[begin:after].lower()))
    if digit.any():
        dots = between & (data == 46)
        starts, ends, _ = X.mask_spans(digit | dots, off)
        seen = np.append(0, np.cumsum(dots))
        for k in np.flatnonzero(seen[ends] - seen[starts] >= 3).tolist():
            for m in IP.finditer(raw, int(starts[k]), int(ends[k])):
                parts = [p.lstrip(b"0") or b"0" for p in m.group().split(b".")]
                if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                    found.append((text_of(m.start()), m.start(), 1, m.end(), b"1" + b".".join(parts)))
        starts, ends, _ = X.mask_spans(digit | (between & ((data == 32) | (data == 45))), off)
        seen = np.append(0, np.cumsum(digit))
        count = seen[ends] - seen[starts]
        for k in np.flatnonzero((count >= 12) & (count <= 19)).tolist():
            a, b = int(starts[k]), int(ends[k])
            digits = raw[a:b].translate(None, b" -")
            if luhn(digits):
                found.append((text_of(a), a, 2, b, b"2" + digits))
        plus = np.flatnonzero((data[:-1] == 43) & digit[1:])
        for a in plus.tolist():
            t = text_of(a)
            m = PHONE.match(raw, a, int(off[t + 1]))
            if m and 9 <= int(seen[m.end()] - seen[a]) <= 15:
                found.append((t, a, 3, m.end(), b"3" + re.sub(rb"[^0-9]", b"", m.group())))
    return sorted(found)


def _h64(value: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(value, digest_size=8).digest(), "little", signed=True)


def _free(starts: np.ndarray, ends: np.ndarray, own: list) -> np.ndarray:
    """Words of a text outside all its base spans."""
    free = np.ones(len(starts), bool)
    for a, b, _ in own:
        free[np.searchsorted(ends, a, side="right"):np.searchsorted(starts, b, side="left")] = False
    return free


def _by_text(spans: list) -> dict[int, list]:
    by: dict[int, list] = {}
    for t, a, k, b, entity in spans:
        by.setdefault(t, []).append((a, b, _h64(entity)))
    return by


def _scan(batches):
    """A row per text (place, id, base spans, its text if it has any); a row per (text, entity)."""
    part, number = TaskContext.get().partitionId(), 0
    span = pa.list_(pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())]))
    names = ["place", "doc_id", "base", "text", "entity", "kind"]
    for batch, data, off in X.chunks(batches, "text"):
        m = batch.num_rows
        spans = base_spans(data, off)
        points = X.code_points(data)
        per: list[list] = [[] for _ in range(m)]
        for t, a, k, b, _ in spans:
            zero = int(points[off[t]])
            per[t].append({"s": int(points[a]) - zero, "k": k, "e": int(points[b]) - zero})
        place = (part << 40) + number + np.arange(m)
        number += m
        ident, text = batch.column("doc_id"), batch.column("text")
        own = pc.if_else(pa.array([bool(x) for x in per], pa.bool_()), text, pa.nulls(m, text.type))
        yield pa.RecordBatch.from_arrays([pa.array(place), ident, pa.array(per, span), own, pa.nulls(m, pa.int64()), pa.array(np.zeros(m, np.int32))], names=names)
        if not spans:
            continue
        rows = sorted({(t, _h64(entity)) for t, _, _, _, entity in spans})
        c = len(rows)
        yield pa.RecordBatch.from_arrays([pa.array(place[[t for t, _ in rows]]), pa.nulls(c, ident.type), pa.nulls(c, span), pa.nulls(c, text.type),
                                          pa.array([e for _, e in rows], pa.int64()), pa.array(np.ones(c, np.int32))], names=names)


def pair_bits(entity, term: np.ndarray) -> np.ndarray:
    """Positions of (entity, term) pairs in their Bloom filter."""
    return (X._finish(np.asarray(entity, np.int64).view(np.uint64) ^ X._finish(term.view(np.uint64))) & np.uint64(BLOOM_BITS - 1)).astype(np.int64)


def bits_of(values: np.ndarray) -> np.ndarray:
    """Positions of entities or terms in a Bloom filter."""
    return (values.view(np.uint64) & np.uint64(BLOOM_BITS - 1)).astype(np.int64)


def _pair_bits(batches):
    for batch in batches:
        bits = pair_bits(np.asarray(batch.column("entity")), np.asarray(batch.column("term")))
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(bits))], names=["b"])


def _gate(spark, bits: DataFrame):
    """A broadcast bit map of the positions in column b."""
    gate = np.zeros(BLOOM_BITS, np.uint8)
    for r in bits.distinct().toArrow().column("b").chunks:
        gate[np.asarray(r)] = 1
    return spark.sparkContext.broadcast(np.packbits(gate))


def _together(shared):
    """Every occurrence of a term that the Bloom filter lets pass, for each entity of its text."""
    def run(batches):
        gate = np.unpackbits(shared.value)
        for batch, data, off in X.chunks(batches, "text"):
            _, starts, ends, first, hashes = X.words(data, off, X.ALNUM)
            points, places = X.code_points(data), np.asarray(batch.column("place"))
            for t, own in _by_text(base_spans(data, off)).items():
                lo, hi = int(first[t]), int(first[t + 1])
                at = lo + np.flatnonzero(_free(starts[lo:hi], ends[lo:hi], own))
                term, zero = hashes[at].view(np.int64), points[off[t]]
                for entity in sorted({e for _, _, e in own}):
                    some = gate[pair_bits(entity, term)].astype(bool)
                    c = int(some.sum())
                    if c:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(c, places[t])), pa.array(np.full(c, entity)), pa.array(term[some]), pa.array(points[starts[at[some]]] - zero),
                                                          pa.array(points[ends[at[some]]] - zero)], names=["place", "entity", "term", "s", "e"])
    return run


def _pairs(shared):
    """(entity, term, documents) of every term in the documents of each entity that the Bloom filter lets pass, merged in the task."""
    def run(batches):
        gate, held, size = np.unpackbits(shared.value), [], 0

        def merge():
            e, t, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((t, e))
            e, t, n = e[order], t[order], n[order]
            first = np.flatnonzero(np.append(True, (e[1:] != e[:-1]) | (t[1:] != t[:-1])))
            return [(e[first], t[first], np.add.reduceat(n, first))]

        def rows():
            return [pa.RecordBatch.from_arrays([pa.array(x) for x in h], names=["entity", "term", "n"]) for h in held]

        for batch, data, off in X.chunks(batches, "text"):
            _, starts, ends, first, hashes = X.words(data, off, X.ALNUM)
            for t, own in _by_text(base_spans(data, off)).items():
                entities = np.array(sorted({e for _, _, e in own}), np.int64)
                entities = entities[gate[bits_of(entities)].astype(bool)]
                lo, hi = int(first[t]), int(first[t + 1])
                if not len(entities) or lo == hi:
                    continue
                term = np.unique(hashes[lo:hi][_free(starts[lo:hi], ends[lo:hi], own)].view(np.int64))
                for entity in entities:
                    held.append((np.full(len(term), entity), term, np.ones(len(term), np.int64)))
                    size += len(term)
                    if size > 2_000_000:
                        held = merge()
                        size = len(held[0][0])
                        if size > 1_000_000:
                            yield from rows()
                            held, size = [], 0
        if size:
            held = merge()
            yield from rows()
    return run


def _passing(shared):
    """Rows whose term the Bloom filter lets pass."""
    def run(batches):
        gate = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(gate[bits_of(np.asarray(batch.column("term")))]))
    return run


def _holding(shared):
    """(term, documents) of words that the Bloom filter lets pass, merged in the task."""
    def run(batches):
        gate, held = np.unpackbits(shared.value), []

        def merge():
            k, inv = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return [(k, np.bincount(inv, weights=np.concatenate([h[1] for h in held]), minlength=len(k)).astype(np.int64))]

        def rows():
            return [pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], names=["term", "n"]) for k, n in held]

        for _, data, off in X.chunks(batches, "text"):
            _, _, _, first, hashes = X.words(data, off, X.ALNUM)
            some = np.flatnonzero(gate[(hashes & np.uint64(BLOOM_BITS - 1)).astype(np.int64)])
            if not len(some):
                continue
            text = np.searchsorted(first, some, side="right") - 1
            order = np.lexsort((hashes[some], text))
            text, h = text[order], hashes[some][order]
            new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))
            k, n = np.unique(h[new], return_counts=True)
            held.append((k, n.astype(np.int64)))
            if sum(len(x[0]) for x in held) > 2_000_000:
                held = merge()
                if len(held[0][0]) > 1_000_000:
                    yield from rows()
                    held = []
        if held:
            held = merge()
            yield from rows()
    return run


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, alpha: float = ALPHA) -> DataFrame:
    """Per document row: doc_id, base and spans (arrays of s, k, e: start, kind's place in KINDS, end in
    code points; ``spans`` also has the disclosing terms)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ident = rows.schema["doc_id"].dataType.simpleString()
    path = scratch_path(spark, "pii")
    schema = f"place long, doc_id {ident}, base array<struct<s:long,k:int,e:long>>, text string, entity long, kind int"
    rows.mapInArrow(_scan, schema).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    found = spark.read.schema(schema).parquet(path)
    texts = found.where("kind = 0").select("place", "doc_id", "base")
    holders = found.where("kind = 0 and text is not null").select("place", "text")
    bits = lambda c: F.col(c).bitwiseAND(BLOOM_BITS - 1).alias("b")

    total = F.lit(texts.count()).cast("double")
    # an entity of fewer than ``support`` documents has no pair that meets it
    entities = materialize(found.where("kind = 1").groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= support))
    pairs = holders.mapInArrow(_pairs(_gate(spark, entities.select(bits("entity")))), "entity long, term long, n long")
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("n_te")).where(F.col("n_te") >= support)
    pairs = materialize(pairs.join(entities, "entity"))
    holding = rows.select("text").mapInArrow(_holding(_gate(spark, pairs.select(bits("term")))), "term long, n long").groupBy("term").agg(F.sum("n").alias("n_t"))
    # PMI >= alpha IC bounds n(t): terms beyond the bound of all their pairs (frequent words) are dropped before pairs meet counts
    most = F.col("n_te") * F.pow(total / F.col("n_e"), F.lit(1.0 - alpha))
    useful = pairs.groupBy("term").agg(F.max(most).alias("most")).join(holding, "term").where(F.col("n_t") <= F.col("most") * (1 + 1e-9))
    useful = materialize(useful.select("term", "n_t"))
    left = pairs.mapInArrow(_passing(_gate(spark, useful.select(bits("term")))), pairs.schema)
    pmi = F.log(F.col("n_te") * total / (F.col("n_t") * F.col("n_e")))
    told = left.join(useful, "term").where(pmi >= alpha * F.log(total / F.col("n_e")) - 1e-12).select("entity", "term")
    told = materialize(told)
    together = holders.mapInArrow(_together(_gate(spark, told.mapInArrow(_pair_bits, "b long"))), "place long, entity long, term long, s long, e long")
    terms = together.join(told, ["entity", "term"]).groupBy("place").agg(
        F.collect_set(F.struct("s", F.lit(4).alias("k"), "e")).alias("terms"))
    out = texts.join(terms, "place", "left")
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "terms")))
    return out.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(spans).alias("spans"))


def _named(spans: str):
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", kinds[x["k"]], x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
                        F.sha2(_named("base"), 256).alias("base_sha256"), _named("spans").alias("spans"))


def sanitise(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: bool = False) -> DataFrame:
    """``docs`` with each span of its text generalised to its kind in brackets, or removed. ``id_col``
    must be unique; a null text stays null."""
    joined = docs.join(found.select(F.col("doc_id").alias("__id"), F.col("spans").alias("__spans")), F.col(id_col).eqNullSafe(F.col("__id")), "left")
    kinds = F.array(*[F.lit("" if remove else f"[{k.upper()}]") for k in KINDS])
    text = F.col(f"`{text_col}`")
    spans = F.filter(F.coalesce("__spans", F.array().cast("array<struct<s:long,k:int,e:long>>")), lambda x: x["e"] > x["s"])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    part = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    walked = F.aggregate(spans, start, lambda a, x: F.when(x["s"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], x["e"]).alias("at"))).otherwise(
        F.struct(F.concat(a["out"], part(a["at"], x["s"]), kinds[x["k"]]).alias("out"), x["e"].alias("at"))))
    clean = F.concat(walked["out"], part(walked["at"], F.length(text).cast("long") + 1))
    return joined.select([(clean if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns])
