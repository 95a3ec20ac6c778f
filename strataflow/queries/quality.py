"""Quality expectations and checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.plans import quality
from strataflow.queries import bind
from strataflow.registry import Tables, query


def judged(name: str, kind: str, column: str, evaluated: str, unexpected: str, threshold: float, source: str) -> str:
    """SQL of one result line."""
    return f"""
SELECT name, kind, "column", CAST(evaluated AS BIGINT) AS evaluated, CAST(unexpected AS BIGINT) AS unexpected,
       CASE WHEN evaluated > 0 THEN (evaluated - unexpected) / evaluated ELSE 1.0 END::DOUBLE AS ratio,
       threshold,
       CASE WHEN evaluated > 0 THEN (evaluated - unexpected) / evaluated ELSE 1.0 END::DOUBLE >= threshold AS success
FROM (SELECT '{name}' AS name, '{kind}' AS kind, '{column}' AS "column",
             CAST({evaluated} AS DOUBLE) AS evaluated, CAST({unexpected} AS DOUBLE) AS unexpected,
             CAST({threshold} AS DOUBLE) AS threshold FROM {source})"""


def range_line(column: str, low: float, high: float) -> str:
    return judged(
        f"{column}_in_range",
        "range",
        column,
        f"COUNT({column})",
        f"COUNT(*) FILTER (WHERE {column} < {low} OR {column} > {high})",
        0.95,
        "fact",
    )


RANGES = [
    range_line("temperature_celsius", -50, 60),
    range_line("humidity_percent", 0, 100),
    range_line("wind_speed_mps", 0, 200),
]

DUPLICATES = """duplicates AS (
  SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


@query(
    bind.sql(
        DUPLICATES,
        body=judged(
            "unique_l_orderkey_l_linenumber",
            "unique",
            "l_orderkey,l_linenumber",
            "SUM(n)",
            "SUM(n) FILTER (WHERE n > 1)",
            1.0,
            "duplicates",
        ),
    )
)
def dq_unique(t: Tables) -> DataFrame:
    return quality.unique_line(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(bind.sql(bind.FACT, body=" UNION ALL ".join(RANGES)))
def dq_range_mostly(t: Tables) -> DataFrame:
    return quality.rule_counts(bind.fact(t), quality.weather_suite().rules)


@query("""
SELECT c_custkey, COUNT(o_orderkey) AS row_count FROM customer LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY c_custkey HAVING COUNT(o_orderkey) < 8
""")
def dq_min_rows(t: Tables) -> DataFrame:
    """Customers with fewer than eight orders."""
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return quality.entities_below(orders, t.customer, "c_custkey", 8)


@query(judged("c_acctbal_positive", "positive", "c_acctbal", "COUNT(c_acctbal)",
              "COUNT(*) FILTER (WHERE NOT c_acctbal > 0)", 1.0, "customer"))
def dq_positive(t: Tables) -> DataFrame:
    return quality.rule_counts(t.customer, [quality.positive("c_acctbal")])


@query("""
SELECT event_id, user_id FROM events
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_acctbal >= 0)
""")
def dq_referential(t: Tables) -> DataFrame:
    """Events whose user is not a customer in credit."""
    dim = t.customer.filter(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("user_id"))
    return quality.missing_references(t.events.select("event_id", "user_id"), dim, "user_id")


KEYED = "keyed AS (SELECT location_id, observed_at, COUNT(*) AS n FROM fact GROUP BY ALL)"
PER_LOCATION = """per_location AS (
  SELECT l.location_id, COUNT(f.event_id) AS n
  FROM location l LEFT JOIN fact f ON l.location_id = f.location_id GROUP BY l.location_id)"""
WEATHER_LINES = [
    *RANGES,
    judged("unique_location_id_observed_at", "unique", "location_id,observed_at", "SUM(n)",
           "COALESCE(SUM(n) FILTER (WHERE n > 1), 0)", 1.0, "keyed"),
    judged("min_rows_per_location_id", "min_rows", "location_id", "COUNT(*)",
           "COUNT(*) FILTER (WHERE n < 1)", 1.0, "per_location"),
    *[judged(f"{c}_exists", "required", c, "1", "0", 1.0, "(SELECT 1)") for c in schemas.WEATHER_REQUIRED],
]


@query(
    bind.sql(
        bind.FACT,
        bind.LOCATION,
        KEYED,
        PER_LOCATION,
        "lines AS (" + " UNION ALL ".join(WEATHER_LINES) + ")",
        body="SELECT 'weather_fact_checkpoint' AS checkpoint_name, 'weather_fact_suite' AS suite_name, * FROM lines",
    )
)
def dq_checkpoint(t: Tables) -> DataFrame:
    """The whole weather suite over the whole fact."""
    suite = quality.weather_suite(bind.location(t))
    return quality.checkpoint(bind.fact(t), suite, "weather_fact_checkpoint")


PER_PAGE = """per_page AS (
  SELECT page_id, COUNT(*) AS n, bool_or(page_id IN (SELECT page_id FROM page WHERE is_current)) AS known
  FROM revision GROUP BY page_id)"""
REVISION_KEYED = "keyed AS (SELECT page_id, revision_id, COUNT(*) AS n FROM revision GROUP BY ALL)"
REVISION_LINES = [
    judged("content_len_positive", "positive", "content_len", "COUNT(content_len)",
           "COUNT(*) FILTER (WHERE NOT content_len > 0)", 1.0, "revision"),
    judged("unique_page_id_revision_id", "unique", "page_id,revision_id", "SUM(n)",
           "COALESCE(SUM(n) FILTER (WHERE n > 1), 0)", 1.0, "keyed"),
    judged("page_id_in_dimension", "referential", "page_id", "SUM(n)",
           "COALESCE(SUM(n) FILTER (WHERE NOT known), 0)", 1.0, "per_page"),
    *[judged(f"{c}_exists", "required", c, "1", "0", 1.0, "(SELECT 1)") for c in schemas.REVISION_REQUIRED],
]


@query(
    bind.sql(
        bind.REVISION,
        bind.PAGE,
        REVISION_KEYED,
        PER_PAGE,
        "lines AS (" + " UNION ALL ".join(REVISION_LINES) + ")",
        body="""
SELECT 'wikipedia_revision_checkpoint' AS checkpoint_name, 'wikipedia_revision_suite' AS suite_name,
       bool_and(success) AS success, COUNT(*) AS evaluated_expectations,
       COUNT(*) FILTER (WHERE success) AS successful_expectations,
       COUNT(*) FILTER (WHERE NOT success) AS unsuccessful_expectations FROM lines""",
    )
)
def dq_summary(t: Tables) -> DataFrame:
    """Statistics of the revision checkpoint; overdrawn customers are missing from the dimension."""
    suite = quality.revision_suite(bind.page(t).filter("is_current"))
    return quality.summary(quality.checkpoint(bind.revision(t), suite, "wikipedia_revision_checkpoint"))


@query("""
SELECT event_id, user_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000
""")
def recent_batch(t: Tables) -> DataFrame:
    """The newest 1000 rows: the default batch of a checkpoint."""
    return quality.recent_batch(t.events.drop("props"), "ts", ["event_id"])
