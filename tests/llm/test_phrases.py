"""Phrase collocations against counting every phrase in a dictionary."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from situate.llm import phrases as P


def lower(s):
    return "".join(c.lower() if c.isascii() else c for c in s or "")


def brute(docs, least, top=2000, share=80):
    f, n = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    f = {k: c for k, c in f.items() if c >= least}
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        longer = [c for (x, q), c in f.items() if x == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if any(100 * c >= share * a for c in longer):
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, k, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items() for k, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1))


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "the", "of", "é", "É", "x-y", "word", "new", "york"]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(["new york city ", "of the ", "of the of the "]) if rng.random() < .3 else rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ";", "\x0b"]) for _ in range(rng.randint(0, 40)))
        out.append((rng.choice(["en", "en", "en", "de", None]), text))
    return out + [("en", None), (None, ""), ("fr", " .,; "), ("und", "of the of the of the"), ("en", "tail word")]


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_WORDS": 60, "CHUNK": 200, "BUCKET_KEYS": 8, "HOT": 12, "KEY_BITS": 24}, {"BLOCK_WORDS": 200, "BUCKET_KEYS": 50, "HOT": 1, "KEY_BITS": 10}])
def test_against_a_dictionary(spark, monkeypatch, sizes):
    """One block, and many blocks, buckets, hot pairs and colliding keys: the same phrases."""
    for k, v in sizes.items():
        monkeypatch.setattr(P, k, v)
    docs = corpus(len(sizes) + sizes.get("HOT", 0))
    df = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "lang string, text string, a int, words string, n int").repartition(3)
    got = sorted(tuple(r) for r in P.mine_phrases(df, least=3, top=25).collect())
    want = brute(docs, 3, 25)
    assert len(want) > 50 and got == want


def test_a_pair_that_holds_a_third(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_KEYS", 16)
    monkeypatch.setattr(P, "HOT", 20)
    monkeypatch.setattr(P, "BLOCK_WORDS", 100)
    rng = random.Random(9)
    docs = [("en", " ".join(f"of the w{rng.randrange(12)}" for _ in range(20))) for _ in range(40)]
    got = sorted(tuple(r) for r in P.mine_phrases(spark.createDataFrame(docs, "lang string, text string"), least=5).collect())
    assert got == brute(docs, 5)


def test_ties_and_repeated_rows(spark):
    docs = [("en", "b a. a b. c d. C D. é f. z z z z z")] * 3
    got = sorted(tuple(r) for r in P.mine_phrases(spark.createDataFrame(docs, "lang string, text string"), least=3, top=4).collect())
    assert got == brute(docs, 3, 4) and [r[2] for r in got][:2] == ["c d", "é f"]


def test_nothing(spark):
    df = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    assert P.mine_phrases(df.where("lang = 'x'")).count() == 0 and P.mine_phrases(df).count() == 0
    assert P.mine_phrases(spark.createDataFrame([(None, None)], "lang string, text string"), least=1).count() == 0


def test_long_text_and_many_languages(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_WORDS", 50)
    docs = [("en", "one two three four five " * 3000)] + [(f"l{i}", "p q r") for i in range(120)]
    got = sorted(tuple(r) for r in P.mine_phrases(spark.createDataFrame(docs, "lang string, text string").coalesce(1), least=1).collect())
    assert got == brute(docs, 1)


def test_scores_pass_64_bits(spark):
    big = 9_000_000_000_000_000_000
    counted = spark.createDataFrame([("x", [1, 2], big // 2)], P.COUNTED)
    single = spark.createDataFrame([("x", [1], big), ("x", [2], big - 1)], P.COUNTED)
    row = P.collocations(counted, single).first()
    assert row["score"] == 2_000_000 * (big // 2) // (2 * big - 1) and (row["l"], row["r"]) == (big, big - 1)


def test_sort_counts_and_packing():
    rng = np.random.default_rng(1)
    n = 3000
    columns = [rng.integers(0, 2, n).astype(np.uint64), *(rng.integers(1, 6, n).astype(np.uint64) for _ in range(4))]
    columns[3][rng.random(n) < .3] = 0
    columns[4][columns[3] == 0] = 0
    weight = rng.integers(1, 4, n)
    want = Counter()
    for row, c in zip(zip(*(x.tolist() for x in columns)), weight.tolist()):
        for k in range(2, 5):
            if row[k]:
                want[row[:k + 1]] += c
    got = {tuple(int(columns[c][at]) for c in range(k + 1)): count for at, k, count in P.multikey_sort(columns, weight, weight, 40)}
    assert got == {k: c for k, c in want.items() if c >= 40}
    values = np.unique(rng.integers(0, 1 << 40, 500)).astype(np.uint64)
    assert (P.unpack(P.pack(values)) == values).all() and len(P.unpack(P.pack(values[:0]))) == 0
