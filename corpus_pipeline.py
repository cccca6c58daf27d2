"""The corpus pipeline over ``documents``: five stages, each written as Parquet and read again.

1. toxicity: trained on the labelled rows whose crc32(doc_id) mod 4 isn't 2; documents it rejects go.
2. near_dedup: one row (the smallest id, null last) of each class of near duplicates stays (5 words, 0.8).
3. decontamination: documents with a benchmark passage go.
4. mixing: the mixture of MIX_WEIGHTS at MIX_SHARE of the tokens, one epoch.
5. token_output: ids in shards with a minimal perfect hash index, read back per document.

All but the last return the columns of documents. Null text passes stage 1 as an empty text; empty texts
are nobody's near duplicate. Stage 2 decides on rows: those that repeat both id and text leave it once, rows
of one id or of a null id with other texts stay by their own text. No SQL can express the network or
the tokenizer, so there is no oracle; tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from situate.llm import decontaminate, mixing, near_dedup, token_store, toxicity
from situate.llm.queries import MIX_SEED, MIX_WEIGHTS, held_out, mix_levels, table, tokenizer_file
from situate.session import scratch_path

MIX_SHARE = (7, 10)
MARKS = ("__mix_tokens", "__copies")
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select([F.col(f"`{c}`").alias(n) for c, n in names.items()])
    others = tuple(n for c, n in names.items() if c not in ("doc_id", "text"))
    scored = toxicity.score(plain, model, id_col=names["doc_id"], text_col=names["text"], keep=others, keep_text=True)
    own = {"doc_id": "doc_id", "text": "text"}
    return scored.where("predicted = 0").select([F.col(own.get(c, n)).alias(c) for c, n in names.items()])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keep = near_dedup.kept_rows(docs, n=5, percent=80)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), near_dedup.text_key(F.col("text")).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.join(keep, rows["id"].eqNullSafe(keep["doc_id"]) & (rows["key"] == keep["text_key"]), "left_semi")
    return rows.groupBy("id", "key").agg(F.min("row").alias("row")).select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), mode="documents")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    up, down = MIX_SHARE
    return mixing.select_mixture(docs, F.expr(f"supply * {up} div {down}"), MIX_WEIGHTS, MIX_SEED, 1, mix_levels(), marks=MARKS).drop(*MARKS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_store.read_tokens(spark, token_store.write_tokens(docs, tokenizer_file()))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("mixing", mix), ("token_output", token_output)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = scratch_path(spark, f"pipeline-{name}")
            out.write.parquet(path)
            out = spark.read.parquet(path)
        docs = out
    return docs
