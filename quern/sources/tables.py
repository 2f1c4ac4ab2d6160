"""Parquet tables and the roles they play in the query catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where none is set."""
    import tempfile

    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="quern-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies: customers, with their nation as municipality. Nations are a
    dimension of fixed size; Catalyst broadcasts it by its own size estimate."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("organisation_number"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.upper("n_name").alias("municipality"), F.col("n_nationkey").alias("municipality_number"), F.col("n_regionkey").alias("region"),
        F.element_at(F.array(F.lit("AS"), F.lit("ASA"), F.lit("ENK"), F.lit("NUF")), (F.col("c_custkey") % 4 + 1).cast("int")).alias("legal_form"),
        F.when(F.col("c_custkey") % 7 != 0, (F.col("c_custkey") % 130).cast("int")).alias("employees"),
        F.col("c_mktsegment").alias("industry_label"), F.col("c_acctbal").alias("balance"), (F.col("c_acctbal") > 0).alias("website"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account records: one per order; the year's best one is chosen later."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("record_id"), F.col("o_orderdate").alias("period_end"), F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderpriority") <= "2-HIGH", F.lit("SELSKAP")).otherwise(F.lit("KONSERN")).alias("account_type"),
        F.col("o_totalprice").alias("revenue"), (F.col("o_totalprice") - F.lit(150000.0)).alias("annual_result"),
    )


#: event type -> (platform, signal type, acquisition mode, source class): the roles of `events`.
EVENT_ROLES = {
    "click": ("company_site", "job_posting", "official_api", "company_owned"),
    "view": ("news", "public_mention", "licensed_api", "independent_news"),
    "purchase": ("google_places", "review", "official_api", "review_site"),
    "signup": ("youtube", "buzz_metrics", "official_api", "independent_news"),
    "error": ("linkedin", "registry_registration", "unofficial_scraper", "scraped"),
}


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation rows from events; every fifth value stands for a defect."""
    role = lambda i: F.coalesce(*(F.when(F.col("event_type") == k, F.lit(v[i])) for k, v in EVENT_ROLES.items()))
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("event_id"), F.col("user_id"), F.lpad(F.col("user_id").cast("string"), 9, "0").alias("organisation_number"),
        role(0).alias("platform"), role(1).alias("signal_type"), role(2).alias("acquisition_mode"), role(3).alias("source_class"),
        F.concat(F.lit("https://"), F.lower("event_type"), F.lit(".example.com/"), F.col("event_id") % 997).alias("source_url"),
        F.col("ts").alias("retrieved_at"), F.sha2(F.col("event_id").cast("string"), 256).alias("content_sha256"),
        (k % 5 != 0).alias("exact_entity"), F.when(k % 6 != 0, F.lit("registry")).alias("identity_proof"),
        F.when(k % 9 != 0, F.lit("approved")).otherwise(F.lit("pending")).alias("rights_status"),
        F.when(k % 4 != 0, F.lit("span")).alias("evidence_span"), k.alias("k"),
        F.when(k % 3 == 0, F.element_at(F.array(*(F.lit(x) for x in ("positive", "neutral", "negative", "mixed"))), (k % 4 + 1))).alias("sentiment_label"),
        F.lit("v1").alias("sentiment_model_version"), (k % 12).cast("string").alias("reviewer_id"), F.col("value"),
    )
