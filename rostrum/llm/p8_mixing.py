"""p8: documents mixed so that each source has its share of all tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm.mixing import Mix, mix, mix_shares
from rostrum.llm.tokens import token_counts
from rostrum.session import materialize, spread, table


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return token_counts(documents, "text", {"doc_id": "doc_id", "source": "source", "lang": "lang"})


def _mixed(spark: SparkSession, sf_dir: str, sizes: DataFrame, total_tokens: float | None = None) -> Mix:
    path = {
        "domain": F.substring_index("source", "_", -1),
        "language": F.coalesce(F.nullif(F.lower(F.trim("lang")), F.lit("und")), F.lit("unknown")),
        "source": F.col("source"),
    }
    return mix(sizes, table(spark, sf_dir, "mix_targets"), "doc_id", "tokens", "source", path, total_tokens)


def _stated(spark: SparkSession, sf_dir: str) -> Mix:
    sizes = materialize(_sizes(spark, sf_dir), "sizes")
    total = sizes.groupBy("doc_id").agg(F.max("tokens").alias("tokens")).agg(F.sum("tokens")).first()[0]
    return _mixed(spark, sf_dir, sizes, float(total or 0))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen documents and how often each is used."""
    return _mixed(spark, sf_dir, _sizes(spark, sf_dir)).rows.withColumnRenamed("id", "doc_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    return mix_shares(materialize(p8_mix(spark, sf_dir), "mix"), table(spark, sf_dir, "mix_targets"))


def p8_mix_stated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix at a stated total, as many tokens as the documents have: small sources reach their most repeats, and their siblings take the shortage."""
    return _stated(spark, sf_dir).rows.withColumnRenamed("id", "doc_id")


def p8_shares_stated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source in that mix."""
    return mix_shares(materialize(p8_mix_stated(spark, sf_dir), "mix"), table(spark, sf_dir, "mix_targets"))


def p8_budgets_stated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per node of the tree of that mix: what it was asked for, its budget, its shortage and what it took over."""
    return _stated(spark, sf_dir).budgets


QUERIES = {"p8_mix": p8_mix, "p8_shares": p8_shares, "p8_mix_stated": p8_mix_stated, "p8_shares_stated": p8_shares_stated, "p8_budgets_stated": p8_budgets_stated}
ORACLE: dict[str, str] = {}
