"""Registered queries of the numbered operators and, where SQL can say the same, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from situate.llm import ctw as CT
from situate.llm import decontaminate as DC
from situate.llm import exact_dedup as ED
from situate.llm import hard_negatives as HN
from situate.llm import html_text as HT
from situate.llm import language as LG
from situate.llm import mixing as MX
from situate.llm import near_dedup as ND
from situate.llm import phrases as PH
from situate.llm import pii as PI
from situate.llm import quality_rules as QR
from situate.llm import token_store as TS
from situate.llm import toxicity as TX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE_SQL[name] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(ident: str = "doc_id", parts: int = 4) -> Column:
    """Rows that no model may learn from."""
    return F.crc32(F.col(ident).cast("string").cast("binary")) % parts == 2


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer file lies (never copied here)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


LOWER_SQL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_ctw")
def op1_ctw(spark, sf_dir):
    scored = CT.score(table(spark, sf_dir, "documents"), ~held_out(parts=7))
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op2_language")
def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = LG.train(docs.where(~held_out()))
    return LG.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = TX.train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return TX.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op4_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY h) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM k
""")
def op4_exact_dedup(spark, sf_dir):
    return ED.exact_groups(table(spark, sf_dir, "documents"))


def mix_levels() -> dict[str, Column]:
    """The tree of ``documents``: four domains made of the sources' numbers, then language, then source."""
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) % 4")
    return {"domain": F.concat(F.lit("d"), F.coalesce(number, F.lit(0)).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


MIX_WEIGHTS = {"domain": {"d0": 2, "d1": 3, "d2": 3, "d3": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}, "source": {}}
MIX_SEED = 11


def _fill_sql(level: str, keys: str, budget: str, weight: str) -> str:
    """One level's common table expressions: have, order, saturation, given."""
    part = f"PARTITION BY {', '.join(keys.split(', ')[:-1])}" if ", " in keys else ""
    last = keys.split(", ")[-1]
    return f"""
{level}_n AS (SELECT {keys}, CAST(sum(tokens) * 2 AS BIGINT) AS have, CAST({weight} AS BIGINT) AS weight FROM leaf GROUP BY {keys}),
{level}_b AS ({budget}),
{level}_o AS (
  SELECT *, coalesce(sum(have) OVER ({part} ORDER BY have / weight, {last} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(weight) OVER ({part} ORDER BY have / weight, {last} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM {level}_b),
{level}_f AS (
  SELECT *, bool_and(have * rest <= weight * (budget - before)) OVER ({part} ORDER BY have / weight, {last}) AS full_ FROM {level}_o),
{level} AS (
  SELECT {keys}, CASE WHEN full_ THEN have ELSE
    weight * (budget - coalesce(sum(CASE WHEN full_ THEN have END) OVER ({part}), 0)) // sum(CASE WHEN NOT full_ THEN weight END) OVER ({part}) END AS given
  FROM {level}_f)"""


@query("op5_mixing", rf"""
WITH doc AS (
  SELECT doc_id, 'd' || coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) % 4, 0) AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CAST(coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0) AS BIGINT) AS tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM doc GROUP BY ALL),
{_fill_sql("l1", "domain", "SELECT *, (SELECT CAST(sum(tokens) AS BIGINT) FROM leaf) * 6 // 5 AS budget FROM l1_n",
           "CASE domain WHEN 'd0' THEN 2 WHEN 'd1' THEN 3 WHEN 'd2' THEN 3 WHEN 'd3' THEN 2 ELSE 1 END")},
{_fill_sql("l2", "domain, lang", "SELECT l2_n.*, l1.given AS budget FROM l2_n JOIN l1 USING (domain)",
           "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END")},
{_fill_sql("l3", "domain, lang, source", "SELECT l3_n.*, l2.given AS budget FROM l3_n JOIN l2 USING (domain, lang)", "1")},
p AS (
  SELECT leaf.*, given, CASE WHEN tokens > 0 THEN least(2, given // tokens) ELSE 2 END AS epochs,
         CASE WHEN (CASE WHEN tokens > 0 THEN least(2, given // tokens) ELSE 2 END) < 2 THEN given - (given // tokens) * tokens ELSE -1 END AS want
  FROM leaf JOIN l3 USING (domain, lang, source)),
r AS (
  SELECT doc.*, epochs, want,
         sum(doc.tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{MIX_SEED}:' || epochs || ':' || doc_id)) AS upto
  FROM doc JOIN p USING (domain, lang, source))
SELECT doc_id, tokens, CAST(epochs + CASE WHEN upto <= want THEN 1 ELSE 0 END AS INTEGER) AS copies
FROM r WHERE epochs + CASE WHEN upto <= want THEN 1 ELSE 0 END > 0
""")
def op5_mixing(spark, sf_dir):
    """A budget of 1.2 times the corpus in at most two epochs."""
    mix = MX.select_mixture(table(spark, sf_dir, "documents"), F.expr("supply * 6 div 5"), MIX_WEIGHTS, MIX_SEED, 2, mix_levels())
    return mix.select("doc_id", F.col("mix_tokens").alias("tokens"), "copies")


@query("op6_token_store")
def op6_token_store(spark, sf_dir):
    manifest = TS.write_tokens(table(spark, sf_dir, "documents"), tokenizer_file())
    return TS.read_tokens(spark, manifest)


@query("op7_decontamination", rf"""
WITH i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
il AS (SELECT *, least(10, len(w)) AS l FROM i WHERE len(w) > 0),
iw AS (
  SELECT DISTINCT item, l, array_to_string(w[p:p + l - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS p FROM il)),
d AS (
  SELECT doc_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
dw AS (
  SELECT doc_id, l, p, array_to_string(w[p:p + l - 1], ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM d, (SELECT DISTINCT l FROM il))),
hit AS (SELECT DISTINCT dw.doc_id, dw.l, dw.p, iw.item FROM dw JOIN iw ON dw.l = iw.l AND dw.g = iw.g),
cover AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM (SELECT DISTINCT doc_id, p, l FROM hit)) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN its USING (doc_id)
""")
def op7_decontamination(spark, sf_dir):
    hits = DC.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return DC.hit_report(hits)


@query("op8_pii")
def op8_pii(spark, sf_dir):
    return PI.report(PI.find_personal_data(table(spark, sf_dir, "documents")))


@query("op9_html_text")
def op9_html_text(spark, sf_dir):
    """The whole text of every page, with its length and line count."""
    text = HT.extract(table(spark, sf_dir, "pages"))
    return text.select("page_id", "text", F.length("text").alias("n_chars"), F.size(F.split("text", "\n")).alias("n_lines"))


@query("op10_near_dedup", rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= 80 * (na.n + nb.n - common)),
reach AS (
  SELECT a AS doc_id, a AS c FROM link
  UNION SELECT l.b, r.c FROM reach r JOIN link l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.c, d.doc_id) AS component_id,
       coalesce(r.c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id) r USING (doc_id)
""")
def op10_near_dedup(spark, sf_dir):
    return ND.near_duplicates(table(spark, sf_dir, "documents"), n=4)


@query("op11_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same,
         CAST(list_sum(list_transform(list_zip(a.q, v.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""")
def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return HN.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


@query("op12_quality_rules", rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p8 AS (SELECT doc_id, w, unnest(range(1, len(w) - {QR.MIN_REPEAT} + 2)) AS p FROM d),
g8 AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, array_to_string(w[p:p + {QR.MIN_REPEAT} - 1], ' ')) AS c FROM p8),
hit AS (SELECT DISTINCT doc_id, unnest(range(p, p + {QR.MIN_REPEAT})) AS q FROM g8 WHERE c > 1),
cover AS (SELECT doc_id, count(*) AS n, sum(length(w[q])) AS chars FROM hit JOIN d USING (doc_id) GROUP BY doc_id),
plong AS (SELECT doc_id, w, unnest(range(1, len(w) - {QR.MAX_LONGEST} + 1)) AS p FROM d JOIN cover USING (doc_id) WHERE n > {QR.MAX_LONGEST}),
long AS (
  SELECT DISTINCT doc_id FROM (
    SELECT doc_id FROM plong GROUP BY doc_id, array_to_string(w[p:p + {QR.MAX_LONGEST}], ' ') HAVING count(*) > 1)),
lines AS (
  SELECT doc_id, sum(c - 1) AS n FROM (
    SELECT doc_id, line, count(*) AS c FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line) GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(cover.chars, 0) AS BIGINT) AS repeat_chars, long.doc_id IS NOT NULL AS long_repeat
  FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN long USING (doc_id)),
b AS (SELECT *, n_words < {QR.MIN_WORDS} OR 100 * n_repeat_words > {QR.MAX_WORDS_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, repeat_chars, base_failed,
       NOT base_failed AND 100 * repeat_chars <= {QR.MAX_CHARS_PERCENT} * word_chars AND NOT long_repeat AS kept
FROM b
""")
def op12_quality_rules(spark, sf_dir):
    """Repeats of MIN_REPEAT words cover what repeated windows of as many words cover, and a repeat longer
    than MAX_LONGEST holds a repeated window of one word more: so SQL can say the verdict by windows."""
    m = QR.measure(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_chars",
                    QR.base_failed().alias("base_failed"), QR.kept().alias("kept"))


@query("op13_phrases", rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_SQL.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[p:p + k - 1], ' ') AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, g, a, string_split(g, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
s AS (
  SELECT cuts.lang, cuts.g, cuts.a, cut, x.a AS l, y.a AS r, CAST((CAST(2000000 AS HUGEINT) * cuts.a) // (x.a + y.a) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = array_to_string(cuts.w[1:cut], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.g = array_to_string(cuts.w[cut + 1:], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
parts AS (SELECT lang, a, w, size, unnest(range(1, k - size + 2)) AS p FROM (SELECT *, unnest(range(2, k)) AS size FROM c)),
inside AS (SELECT DISTINCT lang, array_to_string(w[p:p + size - 1], ' ') AS g, max(a) OVER (PARTITION BY lang, array_to_string(w[p:p + size - 1], ' ')) AS longest FROM parts),
kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, g) WHERE longest IS NULL OR 100 * CAST(longest AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, g AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""")
def op13_phrases(spark, sf_dir):
    return PH.mine_phrases(table(spark, sf_dir, "documents"))
