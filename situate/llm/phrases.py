"""Collocations: phrases of two to LONGEST words that stand together more often than their parts let expect.

Texts (A-Z lower-cased) are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, pieces into words ``[^\\x20\\x09]+``. Counting is a
multikey three-way quicksort of suffix pointers (word positions of a piece) to a depth of LONGEST words:

1. ``blocks``: one scan turns the texts of a language into runs of word numbers with a dictionary each, written
   to the shared folder (BLOCK_WORDS words; a text never has to fit with others). Word counts are summed by Spark.
2. Global routing by leading words: each block sends, for the leading two words of its suffixes, distinct keys of
   KEY_BITS bits with counts to the key's bucket. A bucket sums them and sends back to each block the keys that
   reach ``least``; all other partitions are abandoned there. Keys may collide: that keeps too much, never too little.
   The number of buckets follows the input (BUCKET_KEYS keys a bucket), whatever the languages and words.
3. Suffixes that are left, cut before the first word pair that was abandoned, are combined within their block, and
   routed by their two leading words; by three if the pair alone has HOT occurrences or more, so one pair that holds
   a third of all positions is spread over its continuations. Each bucket is sorted by three-way partitions on one word after the other; the size
   (sum of counts) of an equal partition of k words is the count of that phrase, partitions below ``least`` are abandoned.

Scores, the rule against parts of longer phrases and the ranks are DataFrame work on the counted phrases, in decimals
where a product may pass 64 bits. The text of words is looked up for ranked phrases only.

Words are compared as 64-bit hashes. Defined cases: null text is empty, a null language is ``und``; rows that repeat
count again; a piece ends with its text; ids and extra columns are ignored; an empty table gives an empty result;
ties are broken by the phrase in UTF-8 byte order. ``top`` is the report's length for each language, counts
cover everything.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from situate.llm import textnum as X
from situate.session import materialize, scratch_path

LONGEST = 4
CHUNK, BLOCK_WORDS, BLOCKS_A_FILE = 1 << 21, 1 << 20, 8
KEY_BITS, BUCKET_KEYS, HOT = 40, 1 << 21, 1 << 18
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
WORD = ~SEPARATOR
WORD[[0x20, 0x09]] = False
#: odd multipliers that tell a key's second and third word from its first
SECOND, THIRD = np.uint64(0x9E6C63D0676A9A99), np.uint64(0xD1342543DE82EF95)

BLOCK = "lang string, block long, n_words long, seq binary, dict binary, counts binary, words binary"
ROUTED = "bucket long, block long, keys binary, counts binary"
KEPT = "block long, keys binary, hot binary"
SUFFIXES = "bucket long, lang string, size long, data binary"
COUNTED = "lang string, words array<long>, a long"


# ---- blocks ----------------------------------------------------------------------------------------

def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, where each run of equal keys begins in it, run number of each place in the order)."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


class _Held:
    """Words of one language on their way into a block."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, low, starts, ends, hashes, new) -> None:
        self.parts.append((low, starts, ends, hashes, new))
        self.size += len(starts)

    def block(self, lang: str, number: int) -> list:
        hashes, new = np.concatenate([p[3] for p in self.parts]), np.concatenate([p[4] for p in self.parts])
        order, begin, run = _runs(hashes)
        ids = np.empty(len(hashes), np.int32)
        ids[order] = run + 1
        texts, at = [b""] * len(begin), 0
        shown = order[begin]
        for low, starts, ends, _, _ in self.parts:
            raw = low.tobytes()
            for k in np.flatnonzero((shown >= at) & (shown < at + len(starts))).tolist():
                texts[k] = raw[starts[shown[k] - at]:ends[shown[k] - at]]
            at += len(starts)
        seq = np.insert(ids, np.flatnonzero(new), 0)  # 0 before each piece
        counts = np.diff(np.append(begin, len(hashes))).astype(np.uint32)
        return [lang, number, len(hashes), seq.tobytes(), hashes[shown].tobytes(), counts.tobytes(), b" ".join(texts)]


def _blocks(batches):
    held: dict[str, _Held] = {}
    number = TaskContext.get().partitionId() << 32

    def out(langs):
        nonlocal number
        for lang in langs:
            row = held.pop(lang).block(lang, number)
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=[f.split(" ")[0] for f in BLOCK.split(", ")])

    for batch, data, off in X.chunks(batches, "text", CHUNK):
        low = X.LOWER[data]
        starts, ends, first = X.mask_spans(WORD[low], off)
        if not len(starts):
            continue
        hashes = X.span_hash(X.byte_values(low), starts, ends)
        hashes[hashes == 0] = 1
        before = np.concatenate([[0], np.cumsum(SEPARATOR[low])])[starts]
        new = np.ones(len(starts), bool)
        new[1:] = before[1:] != before[:-1]
        new[first[:-1][np.diff(first) > 0]] = True
        codes = batch.column("lang").dictionary_encode()
        own = np.repeat(np.asarray(codes.indices), np.diff(first))
        for c, lang in enumerate(codes.dictionary.to_pylist()):
            at = np.flatnonzero(own == c)
            if len(at):
                held.setdefault(lang, _Held()).add(low, starts[at], ends[at], hashes[at], new[at])
        yield from out([k for k, h in held.items() if h.size >= BLOCK_WORDS])
        if sum(h.size for h in held.values()) >= 2 * BLOCK_WORDS:  # many languages, none of them large
            yield from out(list(held))
    yield from out(list(held))


def _word_counts(batches):
    for batch in batches:
        for lang, words, counts in zip(*(batch.column(c).to_pylist() for c in ("lang", "dict", "counts"))):
            w = np.frombuffer(words, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(w), pa.string()), pa.array(w), pa.array(np.frombuffer(counts, np.uint32).astype(np.int64))], names=["lang", "w", "c"])


def _word_texts(batches):
    for batch in batches:
        for words, texts in zip(*(batch.column(c).to_pylist() for c in ("dict", "words"))):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(words, np.int64)), pa.array(texts.split(b" "), pa.binary()).cast(pa.string())], names=["w", "text"])


# ---- routing by leading words ----------------------------------------------------------------------

def _lang_key(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]


def pack(values: np.ndarray) -> bytes:
    """Ascending or small whole numbers as byte planes of their differences (the upper planes are mostly 0)."""
    delta = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    return delta.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _pair_keys(lang: str, seq: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ``seq`` where a word pair begins, the KEY_BITS key of its language and words)."""
    at = np.flatnonzero((seq[:-1] > 0) & (seq[1:] > 0))
    key = X._finish(words[seq[at] - 1] * SECOND + words[seq[at + 1] - 1] + _lang_key(lang))
    return at, key >> np.uint64(64 - KEY_BITS)


def _arrays(batch):
    for lang, block, seq, words in zip(*(batch.column(c).to_pylist() for c in ("lang", "block", "seq", "dict"))):
        yield lang, block, np.frombuffer(seq, np.int32), np.frombuffer(words, np.uint64)


def _route_pairs(bits: int):
    def run(batches):
        for batch in batches:
            for lang, block, seq, words in _arrays(batch):
                _, keys = _pair_keys(lang, seq, words)
                keys.sort()
                begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
                counts = np.diff(np.append(begin, len(keys))).astype(np.uint64)
                keys = keys[begin]
                bucket = (keys >> np.uint64(KEY_BITS - bits)).astype(np.int64)
                cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else np.empty(0, np.int64)
                ends = np.append(cut[1:], len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cut]), pa.array(np.full(len(cut), block, np.int64)), pa.array([pack(keys[i:j]) for i, j in zip(cut, ends)], pa.binary()),
                                                  pa.array([pack(np.cumsum(counts[i:j])) for i, j in zip(cut, ends)], pa.binary())], names=["bucket", "block", "keys", "counts"])
    return run


def _abandon(least: int, hot: int):
    """Sums a bucket's keys; tells each block which of its keys reach ``least``, and ``hot``."""
    def run(table: pa.Table) -> pa.Table:
        keys = [unpack(k) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([np.diff(unpack(c), prepend=np.uint64(0)) for c in table.column("counts").to_pylist()]).astype(np.int64)
        every = np.concatenate(keys)
        order, begin, run_ = _runs(every)
        total = np.empty(len(every), np.int64)
        total[order] = np.add.reduceat(counts[order], begin)[run_]
        rows, at = [], 0
        for block, own in zip(table.column("block").to_pylist(), keys):
            sums = total[at:at + len(own)]
            at += len(own)
            if (sums >= least).any():
                rows.append((block, pack(own[sums >= least]), pack(own[sums >= hot])))
        return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "keys": pa.array([r[1] for r in rows], pa.binary()), "hot": pa.array([r[2] for r in rows], pa.binary())})
    return run


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def _route_suffixes(bits: int):
    """Combined suffixes of each block, cut where a pair was abandoned, to the bucket of their leading words."""
    def run(batches):
        for batch in batches:
            for (lang, _, seq, words), kept in zip(_arrays(batch), batch.column("kept").to_pylist()):
                keys = np.sort(np.concatenate([unpack(k["keys"]) for k in kept]))
                hot = np.sort(np.concatenate([unpack(k["hot"]) for k in kept]))
                at, pair = _pair_keys(lang, seq, words)
                alive = np.zeros(len(seq) + LONGEST, bool)
                alive[at] = _member(pair, keys)
                pointers = np.flatnonzero(alive)
                ids = np.zeros((LONGEST, len(pointers)), np.int64)
                go = np.ones(len(pointers), bool)
                for d in range(LONGEST):
                    if d >= 2:
                        go &= alive[pointers + d - 1]
                    ids[d] = np.where(go, seq[np.minimum(pointers + d, len(seq) - 1)], 0)
                wide = np.int64(len(words) + 1)
                order = np.lexsort((ids[2] * wide + ids[3], ids[0] * wide + ids[1]))
                ids = ids[:, order]
                new = np.ones(len(order), bool)
                new[1:] = (ids[:, 1:] != ids[:, :-1]).any(axis=0)
                begin = np.flatnonzero(new)
                deep = np.diff(np.append(begin, len(order)))
                ids = ids[:, begin]
                lead = np.zeros(len(seq), np.uint64)
                lead[at] = pair
                key = lead[pointers[order[begin]]]
                flat = deep.copy()
                spread = _member(key, hot) & (ids[2] > 0)
                if spread.any():  # a hot pair: its own count to the pair's bucket, its suffixes by three words
                    some = np.flatnonzero(spread)
                    pair_new = np.append(True, (ids[:2, some[1:]] != ids[:2, some[:-1]]).any(axis=0))
                    first = some[pair_new]
                    total = np.add.reduceat(deep[some], np.flatnonzero(pair_new))
                    third = X._finish(words[ids[2, some] - 1] * THIRD + key[some])
                    flat[some] = 0
                    ids = np.concatenate([ids, np.stack([ids[0, first], ids[1, first], 0 * first, 0 * first])], axis=1)
                    deep, flat = np.append(deep, 0 * total), np.append(flat, total)
                    key = np.append(key, key[first])
                    key[some] = third >> np.uint64(64 - KEY_BITS)
                hashes = np.append(np.uint64(0), words)[ids]
                bucket = (key >> np.uint64(KEY_BITS - bits)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else np.empty(0, np.int64)
                rows = [order[i:j] for i, j in zip(cut, np.append(cut[1:], len(order)))]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[order[cut]], pa.int64()), pa.array([lang] * len(rows), pa.string()), pa.array([len(r) for r in rows], pa.int64()),
                                                  pa.array([hashes[:, r].tobytes() + deep[r].astype(np.uint64).tobytes() + flat[r].astype(np.uint64).tobytes() for r in rows], pa.binary())],
                                                 names=["bucket", "lang", "size", "data"])
    return run


# ---- sorting ---------------------------------------------------------------------------------------

def multikey_sort(columns: list[np.ndarray], deep: np.ndarray, flat: np.ndarray, least: int):
    """(a pointer, number of words, count) of each phrase with ``least`` occurrences.

    ``columns``: language number, then the words of each suffix (0: none). Three-way partitions on one column
    after the other; ``flat`` counts at two words, ``deep`` beyond. A partition that can't reach ``least`` isn't sorted."""
    stack = [(np.arange(len(deep)), 0)]
    while stack:
        at, c = stack.pop()
        if max(int(deep[at].sum()), int(flat[at].sum())) < least:
            continue
        v = columns[c][at]
        pivot = sorted((v[0], v[len(v) // 2], v[-1]))[1]
        equal = at[v == pivot]
        if len(equal) < len(at):
            stack += [(at[v < pivot], c), (at[v > pivot], c)]
        if c > 2 and pivot == 0:
            continue
        if c >= 2:
            count = int((flat if c == 2 else deep)[equal].sum())
            if count >= least:
                yield int(equal[0]), c, count
            elif c > 2:
                continue
        if c + 1 < len(columns):
            stack.append((equal, c + 1))


def _sort_bucket(least: int):
    def run(table: pa.Table) -> pa.Table:
        langs = table.column("lang").to_pylist()
        names = sorted(set(langs))
        parts = [np.frombuffer(d, np.uint64).reshape(LONGEST + 2, n) for d, n in zip(table.column("data").to_pylist(), table.column("size").to_pylist())]
        number = np.concatenate([np.full(p.shape[1], names.index(x), np.uint64) for p, x in zip(parts, langs)])
        *words, deep, flat = np.concatenate(parts, axis=1)
        lang, phrase, count = [], [], []
        for at, k, n in multikey_sort([number, *words], deep.astype(np.int64), flat.astype(np.int64), least):
            lang.append(names[int(number[at])])
            phrase.append([int(w[at].view(np.int64)) for w in words[:k]])
            count.append(n)
        return pa.table({"lang": pa.array(lang, pa.string()), "words": pa.array(phrase, pa.list_(pa.int64())), "a": pa.array(count, pa.int64())})
    return run


# ---- tables ----------------------------------------------------------------------------------------

def word_blocks(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    path = scratch_path(spark, "phrase-blocks")
    rows.mapInArrow(_blocks, BLOCK).write.option("maxRecordsPerFile", BLOCKS_A_FILE).option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def word_counts(blocks: DataFrame, least: int) -> DataFrame:
    """(lang, words of length one, a) of the words with ``least`` occurrences."""
    every = blocks.select("lang", "dict", "counts").mapInArrow(_word_counts, "lang string, w long, c long")
    return every.groupBy("lang", "w").agg(F.sum("c").alias("a")).where(F.col("a") >= least).select("lang", F.array("w").alias("words"), "a")


def phrase_counts(blocks: DataFrame, least: int) -> DataFrame:
    """(lang, words, a): phrases of 2 to LONGEST words with ``least`` occurrences, words as hashes."""
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    bits = min(max(0, (total // BUCKET_KEYS).bit_length()), KEY_BITS - 8)
    core = blocks.select("lang", "block", "seq", "dict")
    kept = core.mapInArrow(_route_pairs(bits), ROUTED).groupBy("bucket").applyInArrow(_abandon(least, HOT), KEPT)
    kept = kept.groupBy("block").agg(F.collect_list(F.struct("keys", "hot")).alias("kept"))
    suffixes = core.join(kept, "block").select("lang", "block", "seq", "dict", "kept").mapInArrow(_route_suffixes(bits), SUFFIXES)
    return suffixes.groupBy("bucket").applyInArrow(_sort_bucket(least), COUNTED)


def big(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def collocations(counted: DataFrame, single: DataFrame, factor: int = 2_000_000, share: int = 80) -> DataFrame:
    """lang, words, a, l, r, score of the candidates that aren't mostly part of a longer one.

    score: the least over all cuts of floor(factor * a / (l + r)); at equal scores the first cut counts."""
    parts = counted.where(F.size("words") < LONGEST).unionByName(single)
    cuts = counted.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("left"), F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("words").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("words").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr(f"(CAST(a AS DECIMAL(20,0)) * {factor}) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    scored = cuts.groupBy("lang", "words").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best"))
    longer = counted.where(F.size("words") > 2).withColumn("size", F.explode(F.sequence(F.lit(2), F.size("words") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)))
    inside = longer.groupBy("lang", F.slice("words", F.col("at"), F.col("size")).alias("words")).agg(F.max("a").alias("longest"))
    out = scored.join(inside, ["lang", "words"], "left").where(F.col("longest").isNull() | (big("longest") * 100 < big("a") * share))
    return out.select("lang", "words", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))


def spelled(phrases: DataFrame, blocks: DataFrame) -> DataFrame:
    """Adds ``phrase``, the words' texts joined by blanks."""
    needed = phrases.select("lang", "words", F.posexplode("words").alias("pos", "w"))
    texts = blocks.select("dict", "words").mapInArrow(_word_texts, "w long, text string")
    texts = texts.join(needed.select("w").distinct(), "w").dropDuplicates(["w"])
    lines = needed.join(texts, "w").groupBy("lang", "words").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("texts"))
    return phrases.join(lines.select("lang", "words", F.array_join("texts.text", " ").alias("phrase")), ["lang", "words"])


def mine_phrases(docs: DataFrame, least: int = 30, top: int = 2000, share: int = 80, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` by score, a (descending) and phrase."""
    blocks = word_blocks(docs, lang_col, text_col)
    counted = materialize(phrase_counts(blocks, least))
    found = collocations(counted, word_counts(blocks, least), share=share)
    order = [F.desc("score"), F.desc("a")]
    first = found.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top).drop("place")
    total = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    ranked = spelled(materialize(first), blocks).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    return ranked.where(F.col("rank") <= top).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
