"""Driver queries of the subpackage, with their oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.ann import nearest
from quayside.llm.bpe import bpe_digests
from quayside.llm.common import table
from quayside.llm.extract import extract_text
from quayside.llm.jaccard import jaccard_components
from quayside.llm.lines import LINES_SQL, drop_boilerplate
from quayside.llm.mixing import MIX_SQL, domain_of, mix_sources
from quayside.llm.negatives import hard_negatives
from quayside.llm.pieces import piece_digests
from quayside.llm.quality import quality_scores
from quayside.llm.substrings import cut_digests
from quayside.llm.topk import exact_top_k
from quayside.llm.warc import archive_round_trip
from quayside.llm.whiten import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQLS: dict[str, str] = {}


ORACLE_SQLS["op2_lines"] = LINES_SQL
ORACLE_SQLS["op3_mixing"] = MIX_SQL


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocab_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the rows not held out."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that are boilerplate across sites."""
    kept = drop_boilerplate(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    docs = table(spark, sf_dir, "documents").withColumn("domain", domain_of())
    return mix_sources(docs).select("doc_id", "domain", "n_tokens", "copies")


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to Zstandard WARC archives and read back."""
    return archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query
def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that start in an earlier one."""
    return cut_digests(table(spark, sf_dir, "documents"))


@query
def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded again; digests of both."""
    return bpe_digests(table(spark, sf_dir, "documents"), vocab_path())


@query
def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest by cosine of every vector whose id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), 5, lambda i: F.col(i) % 50 == 0)


@query
def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingles have a Jaccard similarity of 0.8 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer inner products of every vector whose id is divisible by 20."""
    return exact_top_k(table(spark, sf_dir, "embeddings"), 20, lambda i: F.col(i) % 20 == 0)


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives of each of the 5 positives of every vector whose id is divisible by 50."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(vectors, lambda i: F.col(i) % 50 == 0)


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whitened on its 8 leading components."""
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


@query
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded to pieces and decoded again; digests of both."""
    return piece_digests(table(spark, sf_dir, "documents"), vocab_path("piece_bpe_32k.model"))
