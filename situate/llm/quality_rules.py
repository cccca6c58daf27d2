"""Quality rules with a suffix-array test for repetition inside a document.

Words are ``[^\\x20\\x09-\\x0D]+``. Each document gets a suffix array over its words: prefix doubling sorts
the suffixes of a chunk of whole documents (a suffix' first key holds its document, so suffixes of two
documents never tie) and only suffixes that still tie are sorted again. Longest common prefixes of
neighbours come from prefix hashes by bisection; a stack enumerates the LCP intervals, those whose
suffixes also differ in the word before are the maximal repeated substrings. The spans of all occurrences of
maximal repeats of ``MIN_REPEAT`` words or more are united.

Rules: ``base_failed`` below ``MIN_WORDS`` words or when more than ``MAX_WORDS_PERCENT`` of 100 words are
in repeats; else the method's verdict fails a text of which more than ``MAX_CHARS_PERCENT`` of 100 word
characters are in repeats, or whose longest repeat has more than ``MAX_LONGEST`` words.

Every document is measured alone, so one map over the input does it: no shuffle, no hot group; memory is
bounded by a chunk, or by the longest text (some 100 bytes for each of its bytes). Words and lines are compared as 64-bit hashes. Defined
cases: null text is empty; an empty text has no words and fails the base rule; ids may be null or repeat
(a row each); overlapping occurrences ("a a a") repeat like others; extra columns are ignored by
``measure`` and kept by ``keep_good``; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from situate.llm import textnum as X

MIN_REPEAT = 8
MIN_WORDS = 20
MAX_WORDS_PERCENT = 30
MAX_CHARS_PERCENT = 30
MAX_LONGEST = 100
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, repeat_chars long, "
            "n_repeats long, longest_repeat long, spans array<struct<start:long,end:long>>")
NAMES = [field.split(" ")[0] for field in MEASURES.split(", ")]


def suffix_array(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions ordered by document and then by the words that follow within it (in hash order).

    ``first`` holds each document's first position (and the end). Prefix doubling: after the round of k
    words, suffixes that share their first k words stand together; only those with equals go on."""
    n = len(words)
    doc = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    end = np.repeat(first[1:], np.diff(first))
    key = X._finish(words + (doc + np.uint64(1)) * np.uint64(X.HASH_BASE))
    order = np.argsort(key)
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = head + 1
    k, longest = 1, int(np.diff(first).max(initial=0))
    while k <= longest:
        last = np.ones(n, bool)
        last[:-1] = new[1:]
        slot = np.flatnonzero(~(new & last))  # places in the array whose suffix has equals so far
        if not len(slot):
            break
        at = order[slot]
        ahead = at + k
        inside = ahead < end[at]
        second = np.where(inside, rank[np.where(inside, ahead, 0)], 0)
        by = np.argsort(rank[at] * (n + 1) + second, kind="stable")
        at, second = at[by], second[by]
        order[slot] = at
        split = np.ones(len(slot), bool)
        split[1:] = (rank[at[1:]] != rank[at[:-1]]) | (second[1:] != second[:-1])
        new[slot] |= split
        rank[at] = slot[np.maximum.accumulate(np.where(split, np.arange(len(slot)), 0))] + 1
        k *= 2
    return order


def common_prefixes(words: np.ndarray, first: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """lcp[i]: words that suffixes order[i - 1] and order[i] share, 0 where fewer than ``least`` (or of two documents)."""
    n = len(order)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    end = np.repeat(first[1:], np.diff(first))
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    a, b = order[:-1], order[1:]
    most = np.minimum(end[a] - a, end[b] - b)
    to = np.flatnonzero((doc[a] == doc[b]) & (most >= least))
    values = words | np.uint64(1)

    def equal(pairs, length):
        x, y = a[pairs], b[pairs]
        return X.span_hash(values, x, x + length) == X.span_hash(values, y, y + length)

    to = to[equal(to, least)]
    low, high = np.full(len(to), least), most[to]
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        mid = (low[open_] + high[open_] + 1) // 2
        same = equal(to[open_], mid)
        low[open_[same]] = mid[same]
        high[open_[~same]] = mid[~same] - 1
    lcp[to + 1] = low
    return lcp


def maximal_repeats(words: np.ndarray, first: np.ndarray, order: np.ndarray, lcp: np.ndarray):
    """(length, left, right) of each LCP interval order[left..right] whose suffixes differ in the word before."""
    start = np.zeros(len(words), bool)
    start[first[:-1][np.diff(first) > 0]] = True
    before = np.where(start, np.uint64(0), np.roll(words, 1))[order] if len(words) else words
    change = np.zeros(len(order) + 1, np.int64)
    change[2:] = np.cumsum(before[1:] != before[:-1])
    inner = np.flatnonzero(lcp > 0)
    if not len(inner):
        return
    cut = np.flatnonzero(np.diff(inner) > 1)
    for i, j in zip(np.append(0, cut + 1).tolist(), np.append(cut, len(inner) - 1).tolist()):
        lo, hi = int(inner[i]), int(inner[j])  # lcp[lo..hi] are positive
        stack: list[tuple[int, int]] = []
        for p, value in enumerate([*lcp[lo:hi + 1].tolist(), 0], lo):
            left = p - 1
            while stack and stack[-1][0] > value:
                length, left = stack.pop()
                if change[p] > change[left + 1]:
                    yield length, left, p - 1
            if value and (not stack or stack[-1][0] < value):
                stack.append((value, left))


def _lines(data: np.ndarray, off: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, for each text."""
    s, e, first = X.mask_spans(data != 10, off)
    upto = np.concatenate([[0], np.cumsum(word)])
    has = upto[e] > upto[s]
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))[has]
    key = X._finish(X.span_hash(X.byte_values(data), s[has], e[has]) + (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(X.HASH_BASE))
    once = np.unique(key, return_index=True)[1]
    return np.bincount(doc, minlength=len(off) - 1) - np.bincount(doc[once], minlength=len(off) - 1)


def measures(data: np.ndarray, off: np.ndarray, least: int) -> list[pa.Array]:
    """The columns of MEASURES for the texts data[off[i]:off[i + 1]]."""
    docs = len(off) - 1
    word = X.NON_SPACE[data]
    s, e, first = X.mask_spans(word, off)
    words = X.span_hash(X.byte_values(data), s, e)
    points = X.code_points(data)
    per_doc = lambda values, at: np.concatenate([[0], np.cumsum(values)])[at]
    size = points[e] - points[s]
    chars = np.diff(per_doc(size, first))
    symbols = np.diff(per_doc(SYMBOLS[data], off))

    order = suffix_array(words, first)
    lcp = common_prefixes(words, first, order, least)
    doc = np.repeat(np.arange(docs), np.diff(first))
    repeats, longest = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    for length, left, _ in maximal_repeats(words, first, order, lcp):
        d = doc[order[left]]
        repeats[d] += 1
        longest[d] = max(longest[d], length)
    # the longest repeat that begins at a word is the end of a maximal one: their spans have the same union
    reach = np.maximum(lcp, np.append(lcp[1:], 0)) if len(lcp) else lcp
    hit = np.flatnonzero(reach)
    mark = np.bincount(order[hit], minlength=len(words) + 1) - np.bincount(order[hit] + reach[hit], minlength=len(words) + 1)
    covered = np.cumsum(mark)[:-1] > 0
    n_covered, c_covered = np.diff(per_doc(covered, first)), np.diff(per_doc(size * covered, first))
    a, b, runs = X.mask_spans(covered, first)
    base = points[off[:-1]]
    run_doc = np.repeat(np.arange(docs), np.diff(runs))
    spans = pa.ListArray.from_arrays(pa.array(runs, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(points[s[a]] - base[run_doc], pa.int64()), pa.array(points[e[b - 1]] - base[run_doc], pa.int64())], names=["start", "end"]))
    numbers = [np.diff(first), chars, symbols, _lines(data, off, word), n_covered, c_covered, repeats, longest]
    return [*(pa.array(x, pa.int64()) for x in numbers), spans]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT) -> DataFrame:
    """One row per row of ``docs``: doc_id and MEASURES (``spans``: repeated passages, code points, end exclusive)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    def run(batches):
        for batch, data, off in X.chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *measures(data, off, min_repeat)], names=["doc_id", *NAMES])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {MEASURES}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_WORDS_PERCENT * F.col("n_words"))


def kept(max_chars_percent: int = MAX_CHARS_PERCENT, max_longest: int = MAX_LONGEST) -> Column:
    """The verdict over the columns of ``measure``."""
    return ~base_failed() & (100 * F.col("repeat_chars") <= max_chars_percent * F.col("word_chars")) & (F.col("longest_repeat") <= max_longest)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text passes; measured in the same map, nothing is joined."""
    plain = docs.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    text = f"c{docs.columns.index(text_col)}"

    def run(batches):
        for batch, data, off in X.chunks(batches, text):
            m = {k: np.asarray(v) for k, v in zip(NAMES[:-1], measures(data, off, MIN_REPEAT))}
            ok = (m["n_words"] >= MIN_WORDS) & (100 * m["n_repeat_words"] <= MAX_WORDS_PERCENT * m["n_words"])
            ok &= (100 * m["repeat_chars"] <= MAX_CHARS_PERCENT * m["word_chars"]) & (m["longest_repeat"] <= MAX_LONGEST)
            yield batch.filter(pa.array(ok))

    return plain.mapInArrow(run, plain.schema).select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
