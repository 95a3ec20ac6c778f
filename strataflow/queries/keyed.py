"""Picks, joins and keyed mutations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.times import ntz
from strataflow.operators import match, merge, pick
from strataflow.operators.aggregate import count_if
from strataflow.operators.keys import placeholder_ids
from strataflow.operators.scd import scd2_apply, scd2_history
from strataflow.plans import reads, reports
from strataflow.queries import bind
from strataflow.registry import Tables, query
from strataflow.schemas import LOCATION_KEY, TOLERANCES
from strataflow.session import stage
from strataflow.sources.tables import with_month

# Picks


@query("""
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) = 1
""")
def latest_per_key(t: Tables) -> DataFrame:
    return pick.latest_per_key(t.events, ["user_id"], "ts", ["event_id"])


@query("""
SELECT source, doc_id, lang, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC NULLS FIRST, doc_id DESC) = 1
""")
def locations_unique(t: Tables) -> DataFrame:
    newest = pick.latest_per_key(t.documents.drop("text"), ["source"], "n_chars", ["doc_id"])
    return newest.select("source", "doc_id", "lang", "n_chars").orderBy("source")


@query(
    bind.sql(
        bind.FACT,
        body="""
SELECT location_id, observed_at, CAST(temperature_celsius AS DOUBLE) AS temperature_celsius,
       CAST(humidity_percent AS DOUBLE) AS humidity_percent, CAST(wind_speed_mps AS DOUBLE) AS wind_speed_mps
FROM fact QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY observed_at DESC) <= 24""",
    )
)
def latest_n_per_entity(t: Tables) -> DataFrame:
    return bind.doubles(
        reads.latest_hours(bind.fact(t)), "temperature_celsius", "humidity_percent", "wind_speed_mps"
    )


@query(
    bind.sql(
        bind.FACT,
        bind.LOCATION,
        body="""
SELECT location_name, observed_at, CAST(temperature_celsius AS DOUBLE) AS temperature_celsius,
       CAST(humidity_percent AS DOUBLE) AS humidity_percent, CAST(wind_speed_mps AS DOUBLE) AS wind_speed_mps
FROM fact f JOIN location l ON f.location_id = l.location_id
WHERE observed_at = (SELECT MAX(observed_at) FROM fact g WHERE g.location_id = f.location_id)""",
    )
)
def latest_by_correlated_max(t: Tables) -> DataFrame:
    rows = reports.latest_observations(bind.fact(t), bind.location(t))
    return bind.doubles(rows, "temperature_celsius", "humidity_percent", "wind_speed_mps")


@query("""
SELECT n_name, c_custkey, c_acctbal FROM nation JOIN customer ON c_nationkey = n_nationkey
QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC NULLS FIRST, c_custkey DESC) = 1
""")
def case_insensitive_latest(t: Tables) -> DataFrame:
    """The newest row per title, where titles differ in case from the wanted ones."""
    titled = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lower("n_name").alias("page_title"), "c_custkey", "c_acctbal"
    )
    newest = pick.latest_per_key(
        titled.withColumn("__title", F.lower("page_title")), ["__title"], "c_acctbal", ["c_custkey"]
    )
    wanted = t.nation.select("n_name", F.lower("n_name").alias("__title"))
    return wanted.join(newest, "__title").select("n_name", "c_custkey", "c_acctbal")


# Titles that exist: "segment, nation" where a customer of that pair is overdrawn, and two bare segments.
TITLES = """titles AS (
  SELECT title, MAX(c_custkey) AS page_id FROM (
    SELECT c_mktsegment || ', ' || n_name AS title, c_custkey
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 0
    UNION ALL
    SELECT c_mktsegment, c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
  GROUP BY title)"""


@query(
    bind.sql(
        bind.LOCATION,
        TITLES,
        """tried AS (
  SELECT location_id, unnest([
    city || ', ' || region || ', ' || country, city || ', ' || region, city || ', ' || country, city,
    location_name || ', ' || region || ', ' || country, location_name || ', ' || region,
    location_name || ', ' || country, location_name]) AS candidate,
    generate_subscripts([1, 2, 3, 4, 5, 6, 7, 8], 1) - 1 AS candidate_position
  FROM location)""",
        body="""
SELECT location_id, CAST(candidate_position AS INTEGER) AS candidate_position, candidate, page_id
FROM tried JOIN titles ON candidate = title
QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY candidate_position) = 1""",
    )
)
def candidate_fallback(t: Tables) -> DataFrame:
    location = bind.location(t)
    pairs = location.filter(F.col("balance") < 0).select(
        F.concat_ws(", ", "city", "country").alias("title"), "location_id"
    )
    bare = location.filter(F.col("city").isin("BUILDING", "MACHINERY")).select(
        F.col("city").alias("title"), "location_id"
    )
    titles = pairs.unionByName(bare).groupBy("title").agg(F.max("location_id").alias("page_id"))
    candidates = pick.candidate_titles(*[F.col(c) for c in ("city", "region", "country", "location_name")])
    found = pick.first_match(location, candidates, titles, "title", ["location_id"])
    return found.select("location_id", "candidate_position", "candidate", "page_id")


# Joins


@query(
    bind.sql(
        bind.LOCATION,
        """raw AS (
  SELECT c_name AS location_name,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) / 1000 AS DECIMAL(10,8))
           + CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(0.00000001 AS DECIMAL(10,8)) ELSE 0 END AS latitude,
         CAST(c_nationkey AS DECIMAL(11,8)) AS longitude
  FROM customer)""",
        body="""
SELECT r.location_name, l.location_id, CASE WHEN l.location_id IS NULL THEN 'unknown_location' END AS reason
FROM raw r LEFT JOIN location l
  ON r.location_name = l.location_name AND r.latitude = l.latitude AND r.longitude = l.longitude""",
    )
)
def natural_key_lookup(t: Tables) -> DataFrame:
    """Surrogates by (name, latitude, longitude) on exact decimals; one unit in the last place is a miss."""
    shift = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("0.00000001").cast("decimal(10,8)")).otherwise(
        F.lit("0").cast("decimal(10,8)")
    )
    raw = t.customer.select(
        F.col("c_name").alias("location_name"),
        ((F.col("c_acctbal").cast(bind.MONEY) / 1000).cast("decimal(10,8)") + shift)
        .cast("decimal(10,8)")
        .alias("latitude"),
        F.col("c_nationkey").cast("decimal(11,8)").alias("longitude"),
    )
    dim = bind.location(t).select("location_id", *LOCATION_KEY)
    found = raw.join(dim, list(LOCATION_KEY), "left")
    reason = F.when(F.col("location_id").isNull(), "unknown_location")
    return found.select("location_name", "location_id", reason.alias("reason"))


NEAREST = """nearest AS (
  SELECT p.event_id, p.user_id, p.ts, v.ts AS matched_ts, v.value AS matched_value, v.props AS matched_props
  FROM events p JOIN events v ON p.user_id = v.user_id
  WHERE p.event_type = 'purchase' AND v.event_type = 'view'
  QUALIFY row_number() OVER (PARTITION BY p.event_id
                             ORDER BY abs(epoch_us(p.ts) - epoch_us(v.ts)), v.ts, v.event_id) = 1)"""


@query(
    bind.sql(
        NEAREST,
        body="""
SELECT e.event_id, e.user_id, e.ts, n.matched_ts, n.matched_value
FROM events e LEFT JOIN nearest n ON e.event_id = n.event_id WHERE e.event_type = 'purchase'""",
    )
)
def nearest_time_match(t: Tables) -> DataFrame:
    """Each purchase with the view of the same user that is nearest in time."""
    purchases = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = t.events.filter("event_type = 'view'").select("event_id", "user_id", "ts", "value")
    return match.nearest_match(purchases, views, ["user_id"], "ts", ["value"], right_tie=["event_id"])


@query(
    bind.sql(
        bind.FACT,
        """matched AS (
  SELECT a.event_id, a.location_id, a.observed_at, a.temperature_celsius, a.humidity_percent, a.wind_speed_mps,
         b.observed_at AS source_observed_at, b.temperature_celsius AS source_temperature_celsius,
         b.humidity_percent AS source_humidity_percent, b.wind_speed_mps AS source_wind_speed_mps
  FROM fact a JOIN fact b ON a.location_id = b.location_id
  WHERE a.conditions = 'purchase' AND b.conditions = 'view'
  QUALIFY row_number() OVER (PARTITION BY a.event_id
    ORDER BY abs(epoch_us(a.observed_at) - epoch_us(b.observed_at)), b.observed_at, b.event_id) = 1)""",
        body="""
SELECT f.event_id, abs(epoch_us(f.observed_at) - epoch_us(source_observed_at)) / 1000000.0::DOUBLE
         AS time_diff_seconds,
       CAST(abs(f.temperature_celsius - source_temperature_celsius) AS DOUBLE) AS temperature_celsius_diff,
       CAST(abs(f.humidity_percent - source_humidity_percent) AS DOUBLE) AS humidity_percent_diff,
       abs(f.temperature_celsius - source_temperature_celsius) < 1.0 AS temperature_celsius_ok,
       abs(f.humidity_percent - source_humidity_percent) < 5.0 AS humidity_percent_ok,
       abs(f.wind_speed_mps - source_wind_speed_mps) < 0.5 AS wind_speed_mps_ok
FROM fact f LEFT JOIN matched m ON f.event_id = m.event_id WHERE f.conditions = 'purchase'""",
    )
)
def tolerance_reconcile(t: Tables) -> DataFrame:
    """Stored hours against the nearest ones of a second feed, within the documented tolerances."""
    fact = bind.fact(t)
    measures = list(TOLERANCES)
    stored = fact.filter("conditions = 'purchase'").select("event_id", "location_id", "observed_at", *measures)
    source = fact.filter("conditions = 'view'").select("event_id", "location_id", "observed_at", *measures)
    checked = match.reconcile(
        stored, source, ["location_id"], "observed_at", TOLERANCES, source_tie=["event_id"]
    )
    out = checked.select(
        "event_id",
        "time_diff_seconds",
        "temperature_celsius_diff",
        "humidity_percent_diff",
        *[f"{m}_ok" for m in measures],
    )
    return bind.doubles(out, "temperature_celsius_diff", "humidity_percent_diff")


# Upserts

HOURLY = """hourly AS (
  SELECT user_id AS location_id, date_trunc('hour', ts) AS observed_at, event_type AS conditions,
         CASE WHEN event_type = 'purchase' AND value > 100 THEN NULL ELSE value END AS temperature_celsius,
         ts, event_id, event_type = 'purchase' AS is_correction
  FROM events),
base AS (
  SELECT * FROM hourly WHERE NOT is_correction
  QUALIFY row_number() OVER (PARTITION BY location_id, observed_at ORDER BY ts DESC, event_id DESC) = 1),
corrections AS (
  SELECT * FROM hourly WHERE is_correction
  QUALIFY row_number() OVER (PARTITION BY location_id, observed_at ORDER BY ts DESC, event_id DESC) = 1)"""


@query(
    bind.sql(
        HOURLY,
        body="""
SELECT COALESCE(b.location_id, c.location_id) AS location_id, COALESCE(b.observed_at, c.observed_at) AS observed_at,
       CASE WHEN c.location_id IS NULL THEN b.temperature_celsius ELSE c.temperature_celsius END
         AS temperature_celsius,
       CASE WHEN c.location_id IS NULL THEN b.conditions ELSE c.conditions END AS conditions,
       CASE WHEN b.location_id IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE b.ts END AS created_at
FROM base b FULL OUTER JOIN corrections c ON b.location_id = c.location_id AND b.observed_at = c.observed_at""",
    )
)
def fact_upsert(t: Tables) -> DataFrame:
    """Purchases correct the hourly rows of all other events; a NULL correction counts, created_at stays."""
    purchase = F.col("event_type") == "purchase"
    hourly = t.events.select(
        F.col("user_id").alias("location_id"),
        F.timestamp_add("HOUR", F.hour("ts"), F.to_date("ts").cast("timestamp_ntz")).alias("observed_at"),
        F.when(~(purchase & (F.col("value") > 100)), F.col("value")).alias("temperature_celsius"),
        F.col("event_type").alias("conditions"),
        "ts",
        "event_id",
        purchase.alias("is_correction"),
    )
    key, order = ["location_id", "observed_at"], ["ts", "event_id"]
    base = merge.one_per_key(hourly.filter(~F.col("is_correction")), key, order).select(
        *key, "temperature_celsius", "conditions", F.col("ts").alias("created_at")
    )
    return merge.merge_upsert(
        base,
        hourly.filter("is_correction"),
        key,
        ["temperature_celsius", "conditions"],
        last_by=order,
        insert_values={"created_at": ntz(bind.NOW)},
    )


def upserted_locations(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(dimension, the same after the batch); every batch row is there twice, as a feed may list it."""
    location = bind.location(t)
    dim = location.filter(F.col("longitude") < 20).drop("balance")
    batch = location.filter(F.col("longitude") >= 5).withColumn("city", F.lower("city"))
    batch = batch.select(*LOCATION_KEY, "country", "region", "city")
    merged = merge.dim_upsert(
        dim,
        batch.unionByName(batch),
        LOCATION_KEY,
        ("country", "region", "city"),
        id_col="location_id",
        now=bind.NOW,
        created_cols=("created_at",),
        touch_cols=("updated_at",),
    )
    return dim, merged


UPSERTED = (
    bind.LOCATION,
    "dim AS (SELECT * FROM location WHERE longitude < 20)",
    """fresh AS (
  SELECT b.* FROM location b ANTI JOIN dim d
    ON b.location_name = d.location_name AND b.latitude = d.latitude AND b.longitude = d.longitude
  WHERE b.longitude >= 5)""",
)


@query(
    bind.sql(
        *UPSERTED,
        body="""
SELECT (SELECT COUNT(*) FROM dim) + COUNT(*) AS row_count, (SELECT COUNT(*) FROM dim) + COUNT(*) AS distinct_ids,
       (SELECT COUNT(*) FROM dim) AS kept_ids, (SELECT MAX(location_id) FROM dim) + 1 AS lowest_new,
       (SELECT MAX(location_id) FROM dim) + COUNT(*) AS highest_new
FROM fresh""",
    )
)
def dim_upsert_ids(t: Tables) -> DataFrame:
    """The surrogates of an upsert: kept ones stay, new ones go on above them without gaps."""
    dim, merged = upserted_locations(t)
    known = dim.select(*LOCATION_KEY, F.col("location_id").alias("old_id"))
    new = F.when(F.col("old_id").isNull(), F.col("location_id"))
    return merged.join(known, list(LOCATION_KEY), "left").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("location_id").alias("distinct_ids"),
        count_if(F.col("old_id") == F.col("location_id")).alias("kept_ids"),
        F.min(new).alias("lowest_new"),
        F.max(new).alias("highest_new"),
    )


@query(
    bind.sql(
        bind.LOCATION,
        "dim AS (SELECT * FROM location WHERE longitude < 20)",
        "batch AS (SELECT *, lower(city) AS new_city FROM location WHERE longitude >= 5)",
        body="""
SELECT COALESCE(d.location_name, b.location_name) AS location_name,
       CASE WHEN b.location_name IS NULL THEN d.city ELSE b.new_city END AS city,
       COALESCE(b.country, d.country) AS country,
       COALESCE(d.created_at, TIMESTAMP '2024-02-01 00:00:00') AS created_at,
       CASE WHEN b.location_name IS NULL THEN d.updated_at ELSE TIMESTAMP '2024-02-01 00:00:00' END AS updated_at,
       d.location_id AS old_id, d.location_id IS NULL AS is_new
FROM dim d FULL OUTER JOIN batch b
  ON d.location_name = b.location_name AND d.latitude = b.latitude AND d.longitude = b.longitude""",
    )
)
def dim_upsert(t: Tables) -> DataFrame:
    """Type-1 upsert on the natural key; new rows get new surrogates, which only this engine numbers."""
    dim, merged = upserted_locations(t)
    known = dim.select(*LOCATION_KEY, F.col("location_id").alias("old_id"))
    return merged.join(known, list(LOCATION_KEY), "left").select(
        "location_name",
        "city",
        "country",
        "created_at",
        "updated_at",
        "old_id",
        F.col("old_id").isNull().alias("is_new"),
    )


# The table holds the orders before this day, the batch those from OVERLAP on, some of them twice.
LOADED_UNTIL = dt.datetime(1998, 1, 1)
OVERLAP = dt.datetime(1997, 1, 1)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, 'table' AS origin FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, 'first' FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = orders.o_orderkey
                  AND o.o_orderdate < TIMESTAMP '1998-01-01 00:00:00')
""")
def insert_ignore(t: Tables) -> DataFrame:
    """A batch in which every row comes twice, into a table that has part of it already."""
    columns = ("o_orderkey", "o_custkey", "o_totalprice")
    table = t.orders.filter(F.col("o_orderdate") < ntz(LOADED_UNTIL)).select(*columns, F.lit("table").alias("origin"))
    fresh = t.orders.filter(F.col("o_orderdate") >= ntz(OVERLAP)).select(
        *columns, F.explode(F.array(F.lit("first"), F.lit("second"))).alias("origin")
    )
    return merge.insert_ignore(table, fresh, ["o_orderkey"], first_by=["origin"])


@query("""
SELECT * FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey
  AND o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2000-01-01 00:00:00')
""")
def insert_if_absent(t: Tables) -> DataFrame:
    """Customers without an urgent order since 2000."""
    urgent = t.orders.filter(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= ntz(dt.datetime(2000, 1, 1)))
    ).select(F.col("o_custkey").alias("c_custkey"))
    return merge.insert_if_absent(urgent, t.customer, ["c_custkey"])


# Type-2 dimensions

HISTORY = """marked AS (
  SELECT user_id, event_type, ts, lag(event_type) OVER w AS before, row_number() OVER w AS rn
  FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
versions AS (
  SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
  FROM marked WHERE rn = 1 OR event_type IS DISTINCT FROM before)"""


@query(
    bind.sql(HISTORY.format(source="events"), body="SELECT *, valid_to IS NULL AS is_current FROM versions"),
    name="scd2_history",
)
def history_of_changes(t: Tables) -> DataFrame:
    return scd2_history(t.events, ["user_id"], "event_type", "ts")


@query(
    bind.sql(
        "early AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')",
        HISTORY.format(source="early"),
        """batch AS (
  SELECT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)""",
        body="""
SELECT v.user_id, v.event_type, valid_from,
       CASE WHEN valid_to IS NULL AND b.event_type IS NOT NULL AND b.event_type <> v.event_type
            THEN TIMESTAMP '2024-02-01 00:00:00' ELSE valid_to END AS valid_to,
       valid_to IS NULL AND NOT (b.event_type IS NOT NULL AND b.event_type <> v.event_type) AS is_current
FROM versions v LEFT JOIN batch b ON v.user_id = b.user_id
UNION ALL
SELECT b.user_id, b.event_type, TIMESTAMP '2024-02-01 00:00:00', NULL, true
FROM batch b LEFT JOIN versions v ON b.user_id = v.user_id AND v.valid_to IS NULL
WHERE v.user_id IS NULL OR v.event_type <> b.event_type""",
    ),
    name="scd2_apply",
)
def batch_of_changes(t: Tables) -> DataFrame:
    """A history up to CUT, then the newest later value of each user as one batch."""
    early = t.events.filter(F.col("ts") < ntz(bind.CUT))
    late = t.events.filter(F.col("ts") >= ntz(bind.CUT))
    history = scd2_history(early, ["user_id"], "event_type", "ts")
    # Written once, as a dimension is in a warehouse: every branch below reads the table.
    dim = stage(history.withColumn("version_id", F.monotonically_increasing_id()), "page-dim")
    batch = pick.latest_per_key(late, ["user_id"], "ts", ["event_id"]).select("user_id", "event_type")
    applied = scd2_apply(dim, batch, ["user_id"], "event_type", bind.NOW, id_col="version_id")
    return applied.select("user_id", "event_type", "valid_from", "valid_to", "is_current")


@query(
    bind.sql(
        """existing AS (
  SELECT p_name || ' #' || p_partkey AS page_title, 'en' AS page_language,
         CASE WHEN p_type = 'SMALL' THEN -p_partkey - 1 ELSE p_partkey + 1 END AS wikipedia_page_id
  FROM part WHERE p_size <= 25)""",
        """absent AS (
  SELECT p_name || ' #' || p_partkey AS page_title, row_number() OVER (ORDER BY p_partkey) AS rn
  FROM part WHERE p_size > 25)""",
        body="""
SELECT page_title, CAST(least((SELECT MIN(wikipedia_page_id) FROM existing), -1) - rn AS BIGINT)
         AS wikipedia_page_id
FROM absent""",
    ),
    name="placeholder_keys",
)
def placeholders_for_absent(t: Tables) -> DataFrame:
    """Negative ids for the parts that are not known as pages, going on below the lowest id in use."""
    title = F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string"))
    wanted = t.part.select(title.alias("page_title"), F.lit("en").alias("page_language"), "p_partkey")
    known = t.part.filter(F.col("p_size") <= 25).select(
        title.alias("page_title"),
        F.lit("en").alias("page_language"),
        F.when(F.col("p_type") == "SMALL", -F.col("p_partkey") - 1)
        .otherwise(F.col("p_partkey") + 1)
        .alias("wikipedia_page_id"),
    )
    fresh = placeholder_ids(wanted, known, "wikipedia_page_id", ["page_title", "page_language"], "p_partkey")
    return fresh.select("page_title", "wikipedia_page_id")


# Deletes, replacement and retention

RANGE = (dt.datetime(1996, 3, 15), dt.datetime(1997, 1, 1))
IN_RANGE = "o_orderdate >= TIMESTAMP '1996-03-15 00:00:00' AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00'"


@query(f"SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE NOT ({IN_RANGE})")
def delete_range(t: Tables) -> DataFrame:
    return merge.delete_range(t.orders, "o_orderdate", *RANGE).select("o_orderkey", "o_orderdate", "o_totalprice")


@query("SELECT event_id, user_id, value FROM events WHERE NOT (value < 5)")
def delete_by_predicate(t: Tables) -> DataFrame:
    return merge.delete_where(t.events, F.col("value") < 5).select("event_id", "user_id", "value")


@query(f"""
SELECT o_orderkey, o_orderdate, o_totalprice, false AS reloaded FROM orders WHERE NOT ({IN_RANGE})
UNION ALL
SELECT o_orderkey, o_orderdate, -o_totalprice, true FROM orders WHERE {IN_RANGE}
""")
def replace_range(t: Tables) -> DataFrame:
    """A date range loaded again with other prices."""
    columns = ("o_orderkey", "o_orderdate")
    table = t.orders.select(*columns, "o_totalprice", F.lit(False).alias("reloaded"))
    start, end = RANGE
    batch = t.orders.filter((F.col("o_orderdate") >= ntz(start)) & (F.col("o_orderdate") < ntz(end))).select(
        *columns, (-F.col("o_totalprice")).alias("o_totalprice"), F.lit(True).alias("reloaded")
    )
    return merge.replace_range(table, batch, "o_orderdate", start, end)


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month, COUNT(*) AS row_count,
       CASE WHEN date_trunc('month', o_orderdate) < DATE '1998-07-01' THEN 'archived' ELSE 'kept' END AS action
FROM orders GROUP BY ALL
""")
def retention_split(t: Tables) -> DataFrame:
    kept, archived = merge.retention_split(with_month(t.orders, "o_orderdate"), "obs_month", dt.date(1998, 7, 1))
    both = kept.withColumn("action", F.lit("kept")).unionByName(archived.withColumn("action", F.lit("archived")))
    return both.groupBy("obs_month", "action").agg(F.count(F.lit(1)).alias("row_count"))


@query("""
SELECT event_id, user_id,
       CASE WHEN user_id IN (SELECT user_id FROM events WHERE value > 400) THEN 'voided' ELSE 'applied' END AS status
FROM events
""")
def atomic_per_entity(t: Tables) -> DataFrame:
    """One event above 400 voids all events of its user."""
    good, voided = merge.split_atomic(
        t.events.select("event_id", "user_id", "value"), ["user_id"], F.col("value") > 400
    )
    return (
        good.withColumn("status", F.lit("applied"))
        .unionByName(voided.withColumn("status", F.lit("voided")))
        .drop("value")
    )


@query(
    bind.sql(
        bind.FACT,
        body="""
SELECT COUNT(*) AS processed, COUNT(*) FILTER (WHERE temperature_celsius > 400) AS rejected,
       COUNT(DISTINCT location_id) AS entities FROM fact""",
    ),
    name="run_counts",
)
def counts_of_a_run(t: Tables) -> DataFrame:
    fact = bind.fact(t)
    per_entity = fact.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("temperature_celsius") > 400).alias("bad")
    )
    return per_entity.agg(
        F.sum("n").alias("processed"), F.sum("bad").alias("rejected"), F.count(F.lit(1)).alias("entities")
    )
