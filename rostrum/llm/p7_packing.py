"""p7: documents packed whole into containers of 2,048 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm.packing import Packing, containers, pack
from rostrum.llm.tokens import token_counts
from rostrum.session import spread, table

CAPACITY = 2048


def _packing(spark: SparkSession, sf_dir: str) -> Packing:
    return pack(token_counts(spread(table(spark, sf_dir, "documents", "doc_id", "text")), "text", {"doc_id": "doc_id"}), "doc_id", "tokens", CAPACITY)


def p7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document (and every piece of a longer one) with its container and the container's unused space."""
    return _packing(spark, sf_dir).rows.withColumnRenamed("id", "doc_id")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers(_packing(spark, sf_dir).rows)


def p7_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers used, the least number that the tokens could need, and the unused share; the program's value, its lower bound, and containers by origin: rounded down, priced in whole, best fit."""
    found = _packing(spark, sf_dir)
    plan, total = found.plan, F.sum("tokens")
    return containers(found.rows).agg(
        F.count("*").alias("containers"), F.ceil(total / CAPACITY).alias("least_containers"), total.alias("tokens"),
        F.round(F.sum("unused") / (F.count("*") * CAPACITY), 6).alias("unused_share"),
        F.lit(round(plan.value, 6)).alias("program_value"), F.lit(round(plan.bound, 6)).alias("program_bound"),
        *(F.lit(n).cast("bigint").alias(f"by_{o}") for o, n in zip(("rounding", "pricing", "best_fit"), plan.origins, strict=True)),
    )


QUERIES = {"p7_packing": p7_packing, "p7_containers": p7_containers, "p7_summary": p7_summary}
ORACLE: dict[str, str] = {}
