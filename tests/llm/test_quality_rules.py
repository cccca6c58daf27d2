"""Suffix-array quality rules against brute-force enumeration of repeats."""

import random
import re

import pytest
from pyspark.sql import functions as F

from situate.llm import quality_rules as Q
from situate.llm import textnum


def brute(text, least):
    """(n_repeat_words, n_repeats, longest_repeat, spans): every substring of words, looked up everywhere."""
    found = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
    w = [m.group() for m in found]
    at = {}
    for i in range(len(w)):
        for j in range(i + least, len(w) + 1):
            at.setdefault(tuple(w[i:j]), []).append(i)
    maximal = 0
    covered, longest = set(), 0
    for s, places in at.items():
        if len(places) < 2:
            continue
        longest = max(longest, len(s))
        covered.update(p for i in places for p in range(i, i + len(s)))
        before = {w[i - 1] if i else None for i in places}
        after = {w[i + len(s)] if i + len(s) < len(w) else (i,) for i in places}
        maximal += len(before) > 1 and len(after) > 1
    spans = []
    for p in sorted(covered):
        if p - 1 in covered:
            spans[-1][1] = found[p].end()
        else:
            spans.append([found[p].start(), found[p].end()])
    return len(covered), maximal, longest, [tuple(s) for s in spans]


def test_repeats_against_every_substring(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for words in ("ab", "abé", "abcdefgh") for _ in range(25)]
    texts += ["a " * 30, "x y z x y z x y z", "a b c d\na b c d\n\na b c d e", "", " \t", "é ü é ü é", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in Q.measure(df, min_repeat=3).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_repeat_words"], r["n_repeats"], r["longest_repeat"], [tuple(s) for s in r["spans"]]) == brute(t, 3), t
        assert r["word_chars"] == sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", t)))
        assert r["repeat_chars"] == sum(len("".join(t[a:b].split())) for a, b in r["spans"])


def test_texts_of_one_chunk_stay_apart(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(i, text) for i in range(20)], "doc_id long, text string").coalesce(1)
    assert {(r["n_repeats"], r["n_repeat_words"]) for r in Q.measure(df).collect()} == {(0, 0)}
    monkeypatch.setattr(textnum.chunks, "__defaults__", (40,))  # every text longer than a chunk
    assert {(r["n_repeats"], r["n_words"]) for r in Q.measure(df).collect()} == {(0, 50)}


def test_rules_and_filter(spark):
    clean = " ".join(f"w{i}" for i in range(1000))
    passage = " ".join(f"p{i}" for i in range(Q.MAX_LONGEST + 1))
    texts = {1: clean, 2: "too short", 3: None, 4: "spam ham " * 50, 5: f"{clean} {passage} {passage}", 6: clean + " " + " ".join(clean.split()[:40])}
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in texts.items()] + [(None, clean, 7, "x")], "doc_id long, text string, n_words int, `kept` string")
    got = {r["doc_id"]: r for r in Q.measure(df).select("*", Q.base_failed().alias("base"), Q.kept().alias("kept")).collect()}
    assert {i: got[i]["base"] for i in texts} == {1: False, 2: True, 3: True, 4: True, 5: False, 6: False}
    assert {i: got[i]["kept"] for i in texts} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True}
    assert got[5]["longest_repeat"] == Q.MAX_LONGEST + 1
    good = Q.keep_good(df)
    assert good.columns == df.columns and sorted(str(r["doc_id"]) for r in good.collect()) == ["1", "6", "None"]


def test_long_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a " * 200_000), (2, "x\n\n# $\nx\nx ")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in Q.measure(df).collect()}
    assert got[1]["n_repeat_words"] == 200_000 and got[1]["longest_repeat"] == 199_999 and got[1]["n_repeats"] == 199_999 - Q.MIN_REPEAT + 1
    assert (got[2]["n_symbols"], got[2]["n_dup_lines"], got[2]["n_words"]) == (2, 1, 5)
    none = df.where("doc_id < 0")
    assert Q.measure(none).count() == 0 and Q.keep_good(none).count() == 0


@pytest.mark.parametrize("k", [1, 2, 8])
def test_suffix_order(k):
    import numpy as np

    rng = random.Random(k)
    docs = [[rng.randrange(1, k + 2) for _ in range(rng.randint(0, 30))] for _ in range(6)]
    words = textnum._finish(np.array([x for d in docs for x in d], np.uint64))
    first = np.cumsum([0, *map(len, docs)])
    order = Q.suffix_array(words, first)
    lcp = Q.common_prefixes(words, first, order, 1)
    assert sorted(order.tolist()) == list(range(len(words)))
    own = np.repeat(np.arange(6), np.diff(first))
    for i in range(1, len(order)):
        a, b = int(order[i - 1]), int(order[i])
        x, y = words[a:first[own[a] + 1]].tolist(), words[b:first[own[b] + 1]].tolist()
        same = 0
        while own[a] == own[b] and same < min(len(x), len(y)) and x[same] == y[same]:
            same += 1
        assert lcp[i] == same
        # neighbours share the longest prefix of any two: whatever stands between shares it too
        if i > 1:
            z = int(order[i - 2])
            both = min(int(lcp[i - 1]), same)
            assert words[z:z + both].tolist() == words[b:b + both].tolist()
