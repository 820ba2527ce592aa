"""The relational operators on the star-schema and event tables: joins, rollups, sampling, judgments, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostrum.operators.evaluate import accepted_tags, import_judgments, weighted_measures
from rostrum.operators.joins import best_per_key
from rostrum.operators.sampling import stratified_sample
from rostrum.session import r6, table
from rostrum.streaming.ingest import sessions, windowed_counts

SEED, SAMPLE = 17, 200


def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities and prices by return flag and line status."""
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") <= F.to_timestamp(F.lit("1998-09-02")))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(net), 2).alias("sum_net"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("lines"))


def region_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by region and nation of the customer: a star of equi-joins."""
    t = lambda n, *c: table(spark, sf_dir, n, *c)
    rows = t("lineitem", "l_orderkey", "l_extendedprice", "l_discount").join(t("orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation", "n_nationkey", "n_name", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.join(t("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("r_name", "n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("lines"))


def top_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dearest line of each order, of ties the first line number."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    return best_per_key(rows.withColumn("line", F.col("l_linenumber")), "l_orderkey", "line", [-F.col("l_extendedprice"), F.col("l_linenumber")])


def idle_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without orders since 1998."""
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate").filter("o_orderdate >= '1998-01-01'").drop("o_orderdate")
    return table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


def supplier_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with their returned lines, also those that have none."""
    lines = table(spark, sf_dir, "lineitem", "l_suppkey", "l_returnflag").filter("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    rows = table(spark, sf_dir, "supplier", "s_suppkey").join(lines, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    return rows.select("s_suppkey", F.coalesce("n", F.lit(0)).alias("returned"))


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and hour."""
    return windowed_counts(table(spark, sf_dir, "events", "ts", "event_type"), "ts", "event_type", "1 hour")


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a user: events less than six hours apart."""
    found = sessions(table(spark, sf_dir, "events", "ts", "user_id"), "ts", "user_id", "6 hours")
    return found.select("user_id", "session_start", "events")


def last_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the last purchase value of its user before it."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return rows.select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("value")), ignorenulls=True).over(order).alias("last_value"))


def _stratum() -> F.Column:
    return F.concat_ws("|", F.coalesce(F.lower("lang"), F.lit("none")), F.coalesce("source", F.lit("none")))


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stratified sample of documents by language and source, with its weights."""
    frame = table(spark, sf_dir, "documents", "doc_id", "lang", "source").withColumn("stratum", _stratum())
    chosen = stratified_sample(frame, "doc_id", "stratum", SAMPLE, SEED)
    return chosen.select("doc_id", "stratum", r6("sample_weight").alias("sample_weight"))


def sample_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample's weights add up to the frame."""
    rows = sample_rows(spark, sf_dir).groupBy("stratum").agg(F.count("*").alias("drawn"), F.round(F.sum("sample_weight"), 3).alias("weight"))
    return rows


def _results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Judgments as a model would give them: of a document's kind and language."""
    docs = table(spark, sf_dir, "documents", "doc_id", "doc_kind", "lang", "n_chars")
    concepts = spark.createDataFrame([("dialogue",), ("talk",)], "slug string")
    one = lambda slug: F.struct(F.when(F.col("doc_kind") == slug, "substantive").otherwise("not_relevant").alias("relevance"), F.when(F.col("n_chars") > 1000, "high").when(F.col("n_chars") > 0, "medium").otherwise("sure").alias("confidence"), F.when(F.col("doc_kind") == slug, "partial").otherwise("not_applicable").alias("definition_like"), F.lit("by kind").alias("rationale"))
    full = F.to_json(F.create_map(F.lit("dialogue"), one("dialogue"), F.lit("talk"), one("talk")))
    partial = F.to_json(F.create_map(F.lit("talk"), one("talk")))
    text = F.when(F.col("lang").isNull(), F.lit("not json")).when(F.lower("lang") == "fr", partial).otherwise(full)
    results = docs.select(F.col("doc_id").cast("string").alias("custom_id"), F.when(F.lower("lang") == "und", "errored").otherwise("succeeded").alias("type"), text.alias("text"))
    return results, concepts, docs.select(F.col("doc_id").alias("anchor_id"))


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imported judgments with their outcomes."""
    return import_judgments(*_results(spark, sf_dir)).withColumn("confidence", r6("confidence")).withColumn("definition_confidence", r6("definition_confidence"))


def judgment_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgments(spark, sf_dir).groupBy("slug", "outcome").agg(F.count("*").alias("rows"))


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags that were adjudicated: those of documents with a title are accepted."""
    verdicts = table(spark, sf_dir, "documents", "doc_id", "title").select(F.col("doc_id").alias("anchor_id"), F.explode(F.array(F.lit("talk"), F.lit("dialogue"))).alias("slug"), F.when(F.col("title").isNotNull(), "accept").otherwise("reject").alias("verdict"))
    return accepted_tags(judgments(spark, sf_dir), verdicts)


def kind_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted measures of a rule (long texts are talks or dialogues) against the document's kind, by source."""
    rows = table(spark, sf_dir, "documents", "doc_kind", "source", "n_chars").select(F.coalesce("source", F.lit("none")).alias("grp"), F.coalesce(F.col("n_chars") > 800, F.lit(False)).alias("predicted"), F.coalesce(F.col("doc_kind").isin("talk", "dialogue"), F.lit(False)).alias("gold"), F.lit(1.5).alias("weight"))
    found = weighted_measures(rows, "grp", "predicted", "gold", "weight")
    return found.select("grp", *(r6(c).alias(c) for c in ("precision", "recall", "f1")))


QUERIES = {
    "pricing_summary": pricing_summary, "region_revenue": region_revenue, "top_lines": top_lines, "idle_customers": idle_customers, "supplier_status": supplier_status,
    "event_windows": event_windows, "event_sessions": event_sessions, "last_state": last_state, "sample_rows": sample_rows, "sample_totals": sample_totals,
    "judgments": judgments, "judgment_outcomes": judgment_outcomes, "accepted": accepted, "kind_measures": kind_measures,
}

_SAMPLE = f"""fr AS (SELECT doc_id, concat_ws('|', coalesce(lower(lang), 'none'), coalesce(source, 'none')) AS stratum FROM documents),
  sz AS (SELECT stratum, count(*) AS members FROM fr GROUP BY stratum), tt AS (SELECT count(*) AS strata, sum(members) AS frame, least({SAMPLE}, sum(members)) AS size FROM sz),
  al AS (SELECT stratum, members, CAST((members - 1) * (size - strata) // (frame - strata) AS BIGINT) AS whole, (members - 1) * (size - strata) % (frame - strata) AS fraction, size - strata AS rest FROM sz, tt),
  qu AS (SELECT stratum, members, 1 + whole + CASE WHEN row_number() OVER (ORDER BY fraction DESC, stratum) <= rest - sum(whole) OVER () AND fraction > 0 THEN 1 ELSE 0 END AS quota FROM al),
  rk AS (SELECT fr.doc_id, stratum, members, quota, row_number() OVER (PARTITION BY stratum ORDER BY sha256('{SEED}:' || doc_id), doc_id) AS n FROM fr JOIN qu USING (stratum)),
  sam AS (SELECT doc_id, stratum, round(members::DOUBLE / quota, 6) AS sample_weight FROM rk WHERE n <= quota)"""
_JUDGED = """dc AS (SELECT d.doc_id, d.doc_kind, d.n_chars, s.slug, CASE WHEN lower(lang) = 'und' THEN 'api_error' WHEN lang IS NULL OR lower(lang) = 'fr' OR NOT coalesce(n_chars > 0, false) THEN 'parse_error' ELSE 'completed' END AS outcome
  FROM documents d, (SELECT unnest(['dialogue', 'talk']) AS slug) s),
  jd AS (SELECT doc_id AS anchor_id, slug, outcome, CASE WHEN outcome = 'completed' THEN CASE WHEN doc_kind = slug THEN 'substantive' ELSE 'not_relevant' END END AS relevance,
    CASE WHEN outcome = 'completed' THEN CASE WHEN n_chars > 1000 THEN 1.0::DOUBLE ELSE 0.67::DOUBLE END END AS confidence, CASE WHEN outcome = 'completed' THEN CASE WHEN doc_kind = slug THEN 'partial' ELSE 'not_applicable' END END AS definition_like,
    CASE WHEN outcome = 'completed' AND doc_kind = slug THEN CASE WHEN n_chars > 1000 THEN 1.0::DOUBLE ELSE 0.67::DOUBLE END END AS definition_confidence FROM dc)"""

ORACLE = {
    "pricing_summary": "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_net, round(avg(l_discount), 6) AS avg_disc, count(*) AS lines FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL",
    "region_revenue": "SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
    "top_lines": "SELECT l_orderkey, arg_min(l_linenumber, (-l_extendedprice, l_linenumber)) AS line FROM lineitem GROUP BY l_orderkey",
    "idle_customers": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= '1998-01-01')",
    "supplier_status": "SELECT s_suppkey, count(l_suppkey) AS returned FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey AND l_returnflag = 'R' GROUP BY s_suppkey",
    "event_windows": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL",
    "event_sessions": """WITH l AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
      s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM l) SELECT user_id, min(ts) AS session_start, count(*) AS events FROM s GROUP BY user_id, n""",
    "last_state": "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_value FROM events",
    "sample_rows": f"WITH {_SAMPLE} SELECT * FROM sam",
    "sample_totals": f"WITH {_SAMPLE} SELECT stratum, count(*) AS drawn, round(sum(sample_weight), 3) AS weight FROM sam GROUP BY stratum",
    "judgments": f"WITH {_JUDGED} SELECT * FROM jd",
    "judgment_outcomes": f"WITH {_JUDGED} SELECT slug, outcome, count(*) AS rows FROM jd GROUP BY ALL",
    "accepted": f"WITH {_JUDGED} SELECT DISTINCT jd.anchor_id, jd.slug FROM jd JOIN documents d ON d.doc_id = jd.anchor_id WHERE outcome = 'completed' AND relevance = 'substantive' AND d.title IS NOT NULL",
    "kind_measures": """WITH x AS (SELECT coalesce(source, 'none') AS grp, coalesce(n_chars > 800, false) AS p, coalesce(doc_kind IN ('talk', 'dialogue'), false) AS g FROM documents),
      s AS (SELECT grp, 1.5::DOUBLE * count(*) FILTER (p AND g) AS tp, 1.5::DOUBLE * count(*) FILTER (p AND NOT g) AS fp, 1.5::DOUBLE * count(*) FILTER (NOT p AND g) AS fn FROM x GROUP BY grp)
      SELECT grp, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM s""",
}
