"""Training-data pipeline over ``documents``: five stages, each an operator of
``quayside.llm`` applied to all that the stage before it kept.

1. quality: documents that the classifier rejects go.
2. lines: lines that are boilerplate across sites go, but for one occurrence;
   a document that consisted of nothing else goes.
3. near_duplicates: one document of each component stays, the one of
   smallest id.
4. mixing: documents are taken by target weights; a document that an epoch
   repeats is repeated as a row.
5. tokens: every row left is encoded, and decoded again for its digest.

``run`` writes each stage's result as Parquet to the folder that all executors
share and reads it back. The first four stages return the columns of
``documents``, with n_chars brought up to date. Edge cases are those of the
operators; a null id stays its own document throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.bpe import bpe_digests
from quayside.llm.common import staged, table
from quayside.llm.jaccard import jaccard_components
from quayside.llm.lines import drop_boilerplate
from quayside.llm.mixing import DEFAULT_MIX, domain_of, mix_sources
from quayside.llm.quality import held_out, score_quality, train_quality
from quayside.llm.registry import vocab_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what scores 0.5 or more; learned as in the query, from rows not held out."""
    model = train_quality(docs, table(spark, sf_dir, "labels"), ~held_out())
    return score_quality(docs.select(COLUMNS), model).filter("score >= 0.5").select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out boilerplate lines, and documents that held nothing else."""
    cut = drop_boilerplate(docs.select(COLUMNS))
    emptied = (F.col("n_removed") > 0) & (F.trim(F.regexp_replace("text", "\n", " ")) == "")
    return cut.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component; of several rows of its id the largest."""
    docs = docs.select(COLUMNS)
    stay = staged(jaccard_components(docs).filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows")), "stay")
    kept = docs.join(stay.filter("rows = 1").select("doc_id"), "doc_id").select(COLUMNS)
    several = stay.filter("rows > 1").select("doc_id")
    if not several.isEmpty():
        one = docs.join(several, "doc_id").groupBy("doc_id").agg(F.max(F.struct(*COLUMNS[1:])).alias("row"))
        kept = kept.unionByName(one.select("doc_id", "row.*"))
    return kept.unionByName(docs.filter("doc_id IS NULL"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mix_sources(docs.select(COLUMNS).withColumn("domain", domain_of()), DEFAULT_MIX).filter("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the decoded text."""
    return bpe_digests(docs, vocab_path(), keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("tokens", tokens)]

#: Training a classifier and merging tokens cannot be said in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE_SQLS = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
