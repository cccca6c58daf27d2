"""Edge cases and brute-force versions of the training-data operators."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from situate.llm import ctw, decontaminate, exact_dedup, html_text, language, mixing, near_dedup, pii, textnum, token_store, toxicity
from situate.llm.queries import ORACLE_SQL, QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"
SPACE = r"[^\x20\x09-\x0D]+"


def lower(s):
    return "".join(c.lower() if c.isascii() else c for c in s or "")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, a long text, ties and repeated rows, and columns that clash with internal names."""
    rows = [(1, "The cat sat on the mat and looked at the dog", "en", "src1"), (2, None, None, None), (3, "", "en", "src2"), (4, " \t\n ", "fr", "src1"),
            (5, "The cat sat on the mat and looked at the dog", "en", "src1"), (5, "The cat sat on the mat and looked at the dog", "en", "src1"),
            (6, "le chat é " * 20000, "fr", "src9"), (7, "one", "en", "x"), (8, "ÉÀ 123 !!", None, "src3")]
    return spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, lang string, source string, n long, `key` string").withColumn("items", F.lit(3)).withColumn("score", F.lit(0))


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id < 0")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in rel.description]
    want = sorted(rel.fetchall())
    assert sorted(tuple(r) for r in QUERIES[name](spark, SF).select(*names).collect()) == want


# ---- op 1

def brute_ctw(training, text, depth):
    """Block probabilities by recursion over the whole tree."""
    def seq(t):
        words = re.findall(SPACE, lower(t))
        return bytes([10]) * depth + (" ".join(words).encode() + b"\n")

    counts = Counter()
    for t in training:
        s = seq(t)
        for i in range(depth, len(s)):
            for k in range(8):
                node, bit = (1 << k) | (s[i] >> (8 - k)), (s[i] >> (7 - k)) & 1
                for d in range(depth + 1):
                    counts[s[i - d:i], node, bit] += 1
    contexts = {}
    for c, node, _ in counts:
        contexts.setdefault((c[1:], node, len(c) - 1), set()).add(c)

    def kt(c, node):
        a, b = counts[c, node, 0], counts[c, node, 1]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def pw(c, node):
        if len(c) == depth:
            return kt(c, node)
        below = sum(pw(x, node) for x in contexts.get((c, node, len(c)), ()))
        return np.logaddexp(kt(c, node), below) - math.log(2)

    s, total = seq(text), 0.0
    for i in range(depth, len(s)):
        for k in range(8):
            node, bit = (1 << k) | (s[i] >> (8 - k)), (s[i] >> (7 - k)) & 1
            p = None
            for d in range(depth, -1, -1):
                c = s[i - d:i]
                guess = (counts[c, node, bit] + .5) / (counts[c, node, 0] + counts[c, node, 1] + 1)
                if d == depth:
                    p = guess
                else:
                    w = math.exp(kt(c, node) - math.log(2) - pw(c, node))
                    p = w * guess + (1 - w) * p
            total += math.log10(p)
    return total


def test_ctw_against_the_whole_tree(spark):
    texts = [(1, "abra cadabra Abra"), (2, "ab é"), (3, None), (4, "cab  abba\tx"), (5, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r for r in ctw.score(df, F.col("doc_id") != 4, depth=3).collect()}
    training = [t for i, t in texts if i != 4]
    words = Counter(w for t in training for w in re.findall(SPACE, lower(t)))
    n, v = sum(words.values()) + 4, len(words) + 1
    for i, t in texts:
        assert got[i]["score"] == pytest.approx(brute_ctw(training, t, 3), rel=1e-5)
        own = re.findall(SPACE, lower(t))
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own) + math.log10(5 / (n + v + 1))
        assert got[i]["base_score"] == pytest.approx(base) and got[i]["n_tokens"] == len(own) + 1
        assert got[i]["n_known"] == sum(words[w] > 0 for w in own) + 1 and got[i]["train_tokens"] == n


def test_ctw_keeps_its_depth_at_every_size(spark, monkeypatch):
    rng = random.Random(5)
    texts = [(i, " ".join("".join(rng.choices("abcde", k=rng.randint(1, 6))) for _ in range(rng.randint(0, 12)))) for i in range(40)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    training = [t for i, t in texts if i % 7]
    whole = {r["doc_id"]: tuple(r) for r in ctw.score(df, F.col("doc_id") % 7 != 0, depth=4).collect()}
    for name, value in (("MAX_RUNS", 20), ("BLOCK_BYTES", 100), ("SUBTREE_RUNS", 10), ("MERGE_AT", 50)):  # an input far beyond every size of the module
        monkeypatch.setattr(ctw, name, value, raising=False)
    monkeypatch.setattr(textnum, "CHUNK", 40)
    monkeypatch.setattr(textnum.chunks, "__defaults__", (40,))
    got = {r["doc_id"]: tuple(r) for r in ctw.score(df, F.col("doc_id") % 7 != 0, depth=4).collect()}
    for i, t in texts:
        assert got[i][-1] == pytest.approx(brute_ctw(training, t, 4), rel=1e-5)
        assert got[i] == pytest.approx(whole[i], rel=1e-6)


def test_ctw_odd_rows(odd, none):
    got = ctw.score(odd, F.col("doc_id") != 3).collect()
    assert len(got) == odd.count() and all(r["score"] < 0 and math.isfinite(r["base_score"]) for r in got)
    assert ctw.score(none, F.lit(True)).count() == 0


def test_ctw_nothing_to_learn(spark):
    row = ctw.score(spark.createDataFrame([(1, "ab")], "doc_id long, text string"), F.lit(False)).first()
    assert row["score"] == pytest.approx(24 * math.log10(0.5)) and row["train_tokens"] == 0 and row["n_known"] == 0


# ---- op 2

def test_language(spark, odd, none):
    model = language.train(spark.read.parquet(f"{SF}/documents.parquet"))
    got = language.predict(spark.read.parquet(f"{SF}/documents.parquet"), model).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.9 and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in language.predict(odd, model).collect()}
    assert [by[i]["lang_pred"] for i in (2, 3, 4)] == ["und"] * 3 and by[8]["lang_pred"] != "und"
    assert language.predict(none, model).count() == 0
    assert language.predict(odd, language.train(none)).select("lang_pred").distinct().collect()[0][0] == "und"


def test_language_rejects_the_unlike(spark):
    rows = [(i, " ".join(random.Random(i).choices(["the", "and", "house", "water", "green"], k=40)), "en") for i in range(60)]
    rows += [(100 + i, " ".join(random.Random(i).choices(["der", "und", "haus", "wasser", "grün"], k=40)), "de") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df)
    got = {r["doc_id"]: r for r in language.predict(spark.createDataFrame([(1, rows[7][1] + " the"), (2, "zzqx kjkj wvwv xqxq")], "doc_id long, text string"), model).collect()}
    assert got[1]["lang_pred"] == "en" and not got[1]["rejected"] and got[2]["rejected"]


# ---- op 3

def test_toxicity_without_words_in_a_label(spark):
    """All texts of one label are blank: the prior, and it ends."""
    for texts, labels in ((["", "good day to you"], [1, 0]), (["bad words here", " \t"], [1, 0]), (["", " ", ""], [1, 0, 1])):
        model = toxicity.fit(texts, np.array(labels), 0.25)
        assert model == {"constant": 0.25}
    got = toxicity.score(spark.createDataFrame([(1, "good day"), (2, None)], "doc_id long, text string"), model).collect()
    assert [r["score"] for r in got] == [0.25, 0.25] and {r["predicted"] for r in got} == {0}


def test_toxicity_counts_an_id_once(spark, monkeypatch):
    """Repeated label rows take no second place in the sample; an id with both labels is toxic."""
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda texts, label, share: seen.update(rows=sorted(zip(texts, label.tolist())), share=share) or {})
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 0)] * 5 + [(2, 0), (2, 1), (3, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    toxicity.train(docs, marks)
    assert seen["rows"] == [("a", 0), ("b", 1), ("c", 1)] and seen["share"] == pytest.approx(2 / 3)


def test_toxicity_learns(spark, odd, none):
    rng = random.Random(3)
    plain = ["ka" + c + d for c in "lmnrst" for d in ("a", "en", "ist", "ol")]
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(plain, k=rng.randint(5, 120))
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = "vilthing" + rng.choice(["", "en", "a"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks.where("doc_id < 300"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert np.mean([got[i]["predicted"] == t for i, t in labels[300:]]) > 0.95
    by = toxicity.score(odd.drop("score"), model).collect()
    assert len(by) == odd.count() and all(0 <= r["score"] <= 1 for r in by) and toxicity.score(none, model).count() == 0
    assert {r["predicted"] for r in by if r["doc_id"] in (2, 3, 4)} == {0}
    assert toxicity.score(odd, toxicity.train(docs, marks.where("toxic = 0"))).agg(F.max("score")).first()[0] == 0


def test_toxicity_gradients():
    g = np.random.default_rng(1)
    hashes = g.integers(0, 1 << 63, 6, dtype=np.int64).astype(np.uint64)
    grams, begin = g.integers(0, 1 << toxicity.GRAM_BITS, 14), np.array([0, 2, 5, 6, 9, 11, 14])
    t = toxicity._Trainer(hashes, grams, begin, rate=0.0)
    index = np.array([[0, 1], [2, 3], [4, -1], [5, -1]])
    alive, label = (index >= 0).astype(np.float32), np.array([1.0, 0.0])

    def loss():
        table = toxicity.project(t.m, toxicity.embed(t.m, hashes, grams, begin))
        x = toxicity.logits(t.m, table, np.where(index < 0, 6, index), alive).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(x)) - label * x))

    for k in ("uf", "ur", "inf", "inr", "v", "w", "gram"):
        t.one = {n: np.zeros_like(v) for n, v in t.m.items()}
        t.step(index, alive, label, np.ones(2))
        at = np.unravel_index(np.abs(t.one[k]).argmax(), t.one[k].shape)
        old, eps = t.m[k][at], 1e-2
        t.m[k][at] = old + eps
        up = loss()
        t.m[k][at] = old - eps
        down = loss()
        t.m[k][at] = old
        assert t.one[k][at] * 10 == pytest.approx((up - down) / (2 * eps), rel=0.05, abs=2e-4)


# ---- op 4

def test_cuckoo_index():
    index, keys = exact_dedup.CuckooIndex(buckets=2), [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for k in keys:
        assert index.get(k) is None
        index.put(k, k[:1])
    assert index.size == 3000 and index.n > 2 and all(index.get(k) == k[:1] for k in keys)
    assert all(index.delete(k) for k in keys[::2]) and not index.delete(keys[0])
    assert all((index.get(k) is None) == (i % 2 == 0) for i, k in enumerate(keys)) and index.size == 1500
    index.put(keys[0], b"again")
    assert index.get(keys[0]) == b"again" and all(index.maybe(k) for k in keys[1::2])


def test_exact_dedup(odd, none):
    got = sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(odd).collect())
    assert got == [(1, 1, 3, True), (2, 4, 3, False), (3, 4, 3, False), (4, 4, 3, True), (5, 1, 3, False), (5, 1, 3, False), (6, 6, 1, True), (7, 7, 1, True), (8, 8, 1, True)]
    assert exact_dedup.exact_groups(none).count() == 0


def test_index_updates(odd):
    index = exact_dedup.build_index(exact_dedup.digests(odd))
    gone = index.where("keep_id in (1, 7)").select("digest")
    added = index.where("keep_id = 7").withColumn("group_size", F.lit(9).cast("long"))
    got = {r["keep_id"]: r["group_size"] for r in exact_dedup.update_index(index, added, gone).collect()}
    assert got == {4: 3, 6: 1, 8: 1, 7: 9}


# ---- op 5

def brute_fill(children, budget):
    """Whole-number water filling by rounds."""
    given, open_ = dict.fromkeys(children, 0), {k for k, (_, w) in children.items() if w > 0}
    while open_:
        total = sum(children[k][1] for k in open_)
        full = {k for k in open_ if children[k][0] * total <= children[k][1] * budget}
        if not full:
            for k in open_:
                given[k] = children[k][1] * budget // total
            break
        for k in full:
            given[k] = children[k][0]
        budget -= sum(children[k][0] for k in full)
        open_ -= full
    return given


@pytest.mark.parametrize("seed", range(3))
def test_budgets(spark, seed):
    rng = random.Random(seed)
    leaves = [(d, la, s, rng.choice([0, 5, 50, 500, 7000])) for d in "ab" for la in ("en", "de", "fr") for s in "xyz"]
    weights = {"domain": {"a": 3, "b": 1}, "lang": {"en": 5, "fr": 0}, "source": {"z": 2}}
    total = rng.choice([100, 3000, 30000])
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixing.budgets(df, total, weights, max_epochs=2).collect()}
    have = lambda *k: sum(2 * x[3] for x in leaves if x[:len(k)] == k)
    w = lambda level, k: weights[level].get(k, 1)
    for d, b in brute_fill({d: (have(d), w("domain", d)) for d in "ab"}, total).items():
        for la, c in brute_fill({x: (have(d, x), w("lang", x)) for x in ("en", "de", "fr")}, b).items():
            for s, e in brute_fill({x: (have(d, la, x), w("source", x)) for x in "xyz"}, c).items():
                assert got[d, la, s] == e


def test_mixture_odd_rows(odd, none):
    levels = {"domain": F.lit("d"), "lang": F.col("lang"), "source": F.col("source")}
    got = mixing.select_mixture(odd, F.col("supply"), {}, 1, 1, levels)
    assert got.count() == odd.count() and got.columns == [*odd.columns, "mix_tokens", "copies"]
    assert mixing.select_mixture(none, 10, {}, 1, 1, levels).count() == 0
    assert mixing.select_mixture(odd, 0, {}, 1, 1, levels).agg(F.sum("mix_tokens")).first()[0] in (0, None)


def test_mixing_of_huge_leaves(spark):
    """8 leaves of 10^13 tokens and uneven weights: products pass 64 bits, budgets stay exact."""
    rows = [(f"d{i % 2}", "en", f"s{i}", 10 ** 13 + i) for i in range(8)]
    weights = {"domain": {"d0": 3_000_000, "d1": 1_000_000}, "source": {f"s{i}": 999_983 + i for i in range(8)}}
    total = 3 * 10 ** 13 + 1
    got = {(r["domain"], r["source"]): r["budget"] for r in mixing.budgets(spark.createDataFrame(rows, "domain string, lang string, source string, tokens long"), total, weights).collect()}
    for d, share in (("d0", total * 3 // 4), ("d1", total // 4)):
        leaves = [i for i in range(8) if f"d{i % 2}" == d]
        assert [got[d, f"s{i}"] for i in leaves] == [(999_983 + i) * share // sum(999_983 + j for j in leaves) for i in leaves]


def test_mixing_keeps_columns_of_any_name(spark):
    names = ["epochs", "cut", "want", "tokens", "copies", "mix_tokens", "before", "__id", "name", "upto"]
    rows = [(i, "a b c " * (i % 4), "en", f"s{i % 3}", *range(len(names))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` int" for n in names))
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    plain = mixing.select_mixture(df.select("doc_id", "text", "lang", "source"), F.expr("supply * 1 div 2"), {}, 3, 1, levels)
    got = mixing.select_mixture(df, F.expr("supply * 1 div 2"), {}, 3, 1, levels, marks=("t", "n"))
    assert got.columns == [*df.columns, "t", "n"] and sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in plain.collect())
    assert {tuple(r[n] for n in names) for r in got.collect()} == {tuple(range(len(names)))}
    marked = mixing.select_mixture(df, F.expr("supply * 1 div 2"), {}, 3, 1, levels)
    assert marked.columns == [c for c in df.columns if c not in ("mix_tokens", "copies")] + ["mix_tokens", "copies"]


# ---- op 6

def test_tokens_round_trip(spark, odd, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    extra = ["  a", "a  ", " two  spaces \n x \n\n y", "<|endoftext|> it's we'll 'S", "naïve  x y", "　 x", "á é ́x", "x\x85 y \x1c z", "\U0001f600 \U0001f600", "a​ b  c", "12 34,5 a1b"]
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()] + [(100 + i, x) for i, x in enumerate(extra)] + [(None, "no key")]
    manifest = token_store.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), tokenizer_file(), shards=3)
    got = sorted((tuple(r) for r in token_store.read_tokens(spark, manifest).collect()), key=lambda r: r[1])
    start, want = 0, []
    for i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    shards = [token_store.Shard(manifest, s[0]) for s in manifest["shards"] if s[1]]
    found = [s.get(104) for s in shards if s.get(104) is not None]
    assert len(found) == 1 and found[0].tolist() == [*t.encode(extra[4], add_special_tokens=False).ids, 0]
    assert [len(s.get_all(5)) for s in shards if s.get_all(5)] == [2] and all(s.get(999) is None for s in shards)
    assert token_store.read_tokens(spark, token_store.write_tokens(none, tokenizer_file())).count() == 0


def test_tokens_of_the_tokenizer_as_loaded(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    texts = ["end.<|endoftext|> next", "two  <|endoftext|>  x", "<|endoftext|><|endoftext|>", "a<|endof", "text|> b", "x <|endoftext|>\n\n y<|endoftext", "|>", None, " <|endoftext|> ", "plain text"]
    rng = random.Random(3)
    texts += ["".join(rng.choices(["<|endoftext|>", " ", "a", "é", ".", "\n", "<|", "endoftext"], k=12)) for _ in range(200)]
    manifest = token_store.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tokenizer_file(), shards=2)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_store.read_tokens(spark, manifest).collect()}
    for i, x in enumerate(texts):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), x


@pytest.mark.parametrize("n", [0, 1, 2, 7, 3000])
def test_perfect_hash(n):
    keys = np.array(sorted(random.Random(n).sample(range(-10**12, 10**12), n)), np.int64)
    pilots, slots = token_store.build_mph(keys)
    assert sorted(slots.tolist()) == list(range(n)) and (token_store.mph_slots(pilots, n, keys) == slots).all()


# ---- op 7

def test_decontamination(spark, odd, none):
    bench = spark.createDataFrame([(10, "ON THE mat, and"), (9, "cat sat on the mat and looked at the dog then left"), (11, None), (12, "!!"), (13, "The cat sat on the mat and looked at the dog")],
                                  "item_id long, text string")
    for block in (1 << 20, 20):
        got = {r["doc_id"]: r for r in decontaminate.hit_report(decontaminate.find_hits(odd.drop("items"), bench, block_bytes=block)).collect()}
        assert (got[1]["n_words"], got[1]["n_hit"], got[1]["n_items"]) == (11, 11, 3)
        assert got[1]["items_sha256"] == hashlib.sha256(b"10,13,9").hexdigest()
        assert not got[6]["contaminated"] and got[2]["n_words"] == 0 and got[7]["n_hit"] == 0
    kept = decontaminate.remove(odd, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 6, 7, 8] and kept.columns == odd.columns
    cut = decontaminate.remove(odd, bench.where("item_id = 10"), mode="spans")
    assert {r["text"] for r in cut.where("doc_id = 1").collect()} == {"The cat sat   looked at the dog"} and cut.count() == odd.count()
    assert decontaminate.remove(none, bench).count() == 0 and decontaminate.remove(odd, bench.where("item_id < 0")).count() == odd.count()


def test_decontamination_by_items_without_id(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "a dog lay here"), (3, "nothing of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "cat sat on"), (None, "dog lay"), (4, "the mat")], "item_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR); INSERT INTO documents VALUES (1, 'the cat sat on the mat'), (2, 'a dog lay here'), (3, 'nothing of it')")
    con.execute("CREATE TABLE benchmark(item_id BIGINT, text VARCHAR); INSERT INTO benchmark VALUES (NULL, 'cat sat on'), (NULL, 'dog lay'), (4, 'the mat')")
    want = sorted(con.execute(ORACLE_SQL["op7_decontamination"]).fetchall())
    for block in (1 << 20, 8):
        hits = decontaminate.find_hits(docs, bench, block_bytes=block)
        assert sorted(map(tuple, decontaminate.hit_report(hits).collect())) == want
    assert [r["doc_id"] for r in decontaminate.remove(docs, bench).collect()] == [3]


# ---- op 8

def test_personal_data(spark, odd, none):
    rows = [(i, f"please greet hermit{i % 3} at old@mail{i % 3}.org about thing") for i in range(9)] + [(20, "please greet about thing"), (21, None), (22, "+49 (30) 1234-5678 or 4111 1111 1111 1111 or 1.2.3.4 or 300.1.1.1")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_personal_data(df)
    got = {r["doc_id"]: r for r in pii.report(found).collect()}
    assert got[4]["spans"] == "term:13:20,email:24:37" and got[20]["spans"] == "" and got[21]["n_email"] == 0
    assert [got[22][f"n_{k}"] for k in pii.KINDS[:4]] == [0, 1, 1, 1]
    assert got[4]["base_sha256"] == hashlib.sha256(b"email:24:37").hexdigest()
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df, found).collect()}
    assert clean[4] == "please greet [TERM] at [EMAIL] about thing" and clean[20] == rows[9][1] and clean[21] is None
    assert pii.report(pii.find_personal_data(odd)).count() == odd.count() and pii.find_personal_data(none).count() == 0


def test_disclosing_terms_of_whole_documents(spark):
    far = " ".join(f"w{k}" for k in range(30))
    rows = [(0, "Hermione Li wrote: li@mail.org"), (1, "hermione " + far + " li@mail.org " + far + " Hermione li")] + [(i, f"Hermione Li {far} li@mail.org") for i in range(2, 6)]
    rows += [(i, far) for i in range(6, 40)] + [(40, "hermione li without")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_personal_data(df, alpha=0.8)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df, found).collect()}
    assert clean[0].startswith("[TERM] [TERM] ") and clean[1] == f"[TERM] {far} [EMAIL] {far} [TERM] [TERM]"
    assert all(clean[i] == f"[TERM] [TERM] {far} [EMAIL]" for i in range(2, 6)) and clean[40] == "hermione li without"


def test_disclosing_terms_far_from_their_entity(spark):
    far = " ".join(f"w{k}" for k in range(30))
    rows = [(i, f"Hermione {far} li@mail.org") for i in range(4)] + [(i, far) for i in range(4, 40)] + [(40, f"{far} once@mail.org {far} rare")]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["spans"] for r in pii.report(found).collect()}
    at = len("Hermione " + far) + 1
    assert all(got[i] == f"term:0:8,email:{at}:{at + 11}" for i in range(4)) and got[4] == "" and got[40] == f"email:{len(far) + 1}:{len(far) + 14}"


def brute_spans(t):
    out = []
    for k, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            if (k == 1 and any(int(x) > 255 for x in m.group().split("."))) or (k == 2 and not (12 <= len(d) <= 19 and pii.luhn(d.encode()))) or (k == 3 and not 9 <= len(d) <= 15):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_by_brute_force():
    rng = random.Random(5)
    texts = ["".join(rng.choices("ab@.+- (0123456789)é4111\n", k=rng.randint(0, 80))) for _ in range(4000)]
    texts += ["".join(rng.choices("ab@@.-", k=rng.randint(0, 60))) for _ in range(2000)]
    data, off = textnum.utf8(pa.array(texts))
    points = textnum.code_points(data)
    got = [[] for _ in texts]
    for t, a, k, b, _ in pii.base_spans(data, off):
        got[t].append((int(points[a] - points[off[t]]), k, int(points[b] - points[off[t]])))
    assert got == [brute_spans(t) for t in texts]


def test_base_spans_of_long_runs_take_linear_time():
    n = 1_000_000
    texts = ["x@" + "a" * n, "a" * n + "@", "@" * n, "a@b.c" + "." * n, "1." * n, "+1" + " " * n]
    data, off = textnum.utf8(pa.array(texts))
    begin = time.perf_counter()
    got = [(t, k) for t, _, k, _, _ in pii.base_spans(data, off)]
    assert time.perf_counter() - begin < 60
    assert (3, 0) in got and {k for t, k in got if t != 4} == {0} and sum(t == 4 for t, _ in got) == n // 4


def test_samples_hold_one_text_of_a_repeated_id(spark):
    rows = [(1, "nasty vile words here", "en"), (2, "kind and mild words", "en")] + [(3, "le chat dort bien", "fr")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = {}
    def fit(texts, label, share):
        seen["n"] = len(texts)
        return {"constant": 0.0}
    own, toxicity.fit = toxicity.fit, fit
    try:
        toxicity.train(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int"))
    finally:
        toxicity.fit = own
    assert seen["n"] == 3
    model = language.train(docs)
    assert sorted(set(model["names"])) == ["en", "fr"] and model["names"].count("fr") == 1


# ---- op 9

def test_html():
    page = ("<html><head><title>x</title><style>p{}</style></head><body><h1>Head &amp; line</h1><p>one<p>two <b>bold</b> x<br>next"
            "<ul><li>a<li>b<ol start=3><li>n1<li>n2</ol><li>c</ul><table><caption>Cap</caption><tr><th>Name<th>Val<tr><td>long name<td>1<tr><td>x<td>22</table>"
            "<div hidden>no</div><div style='display: none'>no</div><pre>  keep\n   this </pre><blockquote>q</blockquote>tail<script>if(a<b){}</script>&nbsp;end")
    assert html_text.page_text(page).split("\n") == [
        "Head & line", "", "one", "", "two bold x", "next", "", "- a", "- b", "  3. n1", "  4. n2", "- c", "", "Cap", "Name       Val", "long name  1", "x          22", "",
        "  keep", "   this", "", "> q", "", "tail end"]
    assert html_text.page_text("") == "" and html_text.page_text("<p>a</p></div><b>c") == "a\n\nc"
    assert html_text.page_text("<div>" * 5000 + "deep") == "deep" and html_text.page_text("a < b <") == "a < b <"
    words = ["w%d" % i for i in range(300)]
    tags = ["<p>", "<li>", "</div>", "<td>", "<table>", "<tr>", "</table>", "<b>", "<ul>", "</ul>", "<blockquote>", "<dd>", "<h2>"]
    for seed in range(60):  # whatever the tags, every visible word comes out once
        rng = random.Random(seed)
        own = "".join(f"{rng.choice(tags)} {w} " for w in words)
        assert Counter(re.findall(r"w\d+", html_text.page_text(own))) == Counter(words)


def test_html_shows_what_the_page_shows():
    page = ("<p>f <math><mi>x</mi><mo>=</mo><mn>2</mn></math> <span aria-hidden='true'>icon</span></p><svg><path style='display:none'/><title>t</title><text>one</text><text>two</text></svg>"
            "<select><option>red<option>blue</select>end")
    assert html_text.page_text(page).split("\n") == ["f x=2 icon", "", "one", "two", "red", "blue", "end"]
    deep = "<font>" * 1000
    assert html_text.page_text(deep + "a <span hidden>no <b>no</b> <span>no</span> no</span>b<p style='display:none'>no<p>c") == "a b\n\nc"
    assert html_text.page_text(deep + "<div style='display:none'>no<p>no</div>yes") == "yes"


def test_html_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "<p>a", "x"), (3, "<p>" + "b " * 50000, "x")], "page_id long, html string, text string")
    got = sorted(((r["page_id"], r["text"]) for r in html_text.extract(df).collect()), key=str)
    assert got[:3] == [(1, None), (2, ""), (2, "a")] and len(got[3][1]) == 99999 and html_text.extract(df.where("page_id < 0")).count() == 0


# ---- op 10

def brute_classes(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(SPACE, lower(t))
        sets[i] = {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    comp = {i: i for i in sets}
    change = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while change:
        change = False
        for a, b in links:
            m = min(comp[a], comp[b])
            change |= comp[a] != m or comp[b] != m
            comp[a] = comp[b] = m
    return {i: (len(sets[i]), comp[i]) for i in sets}


def test_near_duplicates_by_brute_force(spark):
    rng, rows = random.Random(9), []
    for g in range(25):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 12, 60, 200]))]
        for _ in range(rng.randint(1, 8)):
            w = list(base)
            for _ in range(rng.randrange(max(1, len(w) // 25) + 1)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n=4).collect()}
    assert got == brute_classes(rows, 4, 80)


def test_near_duplicates_odd_rows(odd, none):
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(odd).collect())
    assert got == [(1, 7, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 7, 1, False), (5, 7, 1, False), (6, 3, 6, True), (7, 1, 7, True), (8, 1, 8, True)]
    assert near_dedup.near_duplicates(none).count() == 0


def test_bbit_estimates():
    rng = np.random.default_rng(4)
    pool = rng.integers(1, 1 << 63, 6000, dtype=np.int64).astype(np.uint64)
    for share in (0.3, 0.6, 0.8, 0.95):
        err = []
        for k in range(30):
            n = 150
            both = round(2 * n * share / (1 + share))
            x = pool[k * 100:k * 100 + 2 * n - both]
            a, b = np.sort(x[:n]), np.sort(x[-n:])
            sets, begin = np.concatenate([a, b]), np.array([0, n, 2 * n])
            s = near_dedup.pack(near_dedup.minima(sets, begin))
            err.append(float(near_dedup.estimate(s[0], s[1])) - both / (2 * n - both))
        assert abs(np.mean(err)) < 0.03 and max(map(abs, err)) < 0.2


# ---- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        path = token_store.scratch_path(spark, "test")
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        rows = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
        kept = {r["doc_id"] for r in docs.collect()}
        assert kept <= {i for i, _ in rows} and docs.count() == len(kept)
        if name == "near_dedup":
            assert kept == {i for i, (_, c) in brute_classes(rows, 5, 80).items() if c == i}
    final = P.STAGES[-1][1](spark, docs, SF)
    assert final.count() == docs.count()
    again = P.run(spark, SF)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, final.collect()))


def test_pipeline_odd_rows(spark, odd):
    import corpus_pipeline as P

    for docs in (odd.withColumn("place", F.lit(1)), odd.where("doc_id < 0")):
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_pipeline_near_dedup_decides_on_rows(spark):
    import corpus_pipeline as P

    def text(seed):
        return " ".join(f"w{random.Random(seed * 1000 + k).randrange(10**6)}" for k in range(60))

    a, b, c, d, e = (text(i) for i in range(5))
    rows = [(None, a), (None, b), (None, a + " tail"), (7, c), (7, d), (7, d), (3, e), (None, e), (9, e + " more"), (None, None), (8, None), (8, ""), (8, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")).repartition(4)
    got = sorted(((r["doc_id"], r["text"]) for r in P.drop_near_duplicates(spark, docs, SF).collect()), key=str)
    assert (None, b) in got and len([x for x in got if x[1] in (a, a + " tail")]) == 1  # classes without any id keep one row each
    assert (7, c) in got and got.count((7, d)) == 1  # one id with two texts
    assert [x for x in got if x[1] and x[1].startswith(e)] == [(3, e)] and len(got) == 8 and (8, " ") in got
    out = near_dedup.near_duplicates(docs).collect()
    ids = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in out if r["n_shingles"] in (56, 57)), key=str)
    assert ids == sorted([(None, None, True)] * 3 + [(7, 7, True)] * 3 + [(3, 3, True), (None, 3, False), (9, 3, False)], key=str)
