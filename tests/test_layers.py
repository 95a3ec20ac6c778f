"""Payload parsing, quality suites, storage, the daily run and the incremental run on small fixtures."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataflow import schemas, session
from strataflow.operators.shape import conform, contract_report, evolve
from strataflow.plans import daily, marts, pages, quality, reads, reports, weather
from strataflow.schemas import LOCATION, PAGE, RAW_PAGES, RAW_WEATHER, REVISION, WEATHER
from strataflow.sources import landing, seeds, tables
from strataflow.sources.tables import Warehouse
from strataflow.streaming.incremental import run_incremental

NOW = dt.datetime(2024, 11, 8, 6)
PLACES = {"Boston": ("42.3601", "-71.0589"), "Chicago": ("41.8781", "-87.6298")}
HOURS = ["2024-11-08T00:00", "2024-11-08T01:00", "2024-11-08T02:00", "2024-11-08T03:00"]


def payload(times=HOURS, offset=0, **arrays):
    n = len(times)
    hourly = {
        "time": times,
        "temperature_2m": [3.5, 4.25, 5.0, 6.75][:n],
        "relativehumidity_2m": [41.0, 43.5, 90.0, 12.0][:n],
        "precipitation": [1.1, 0.0, 0.0, 7.3][:n],
        "cloudcover": [5.0, 100.0, 80.0, 33.0][:n],
        "windspeed_10m": [12.5, 7.2, 3.6, 18.0][:n],
    }
    hourly.update(arrays)
    return json.dumps({"utc_offset_seconds": offset, "hourly": {k: v for k, v in hourly.items() if v != "absent"}})


def raw_rows(spark, *rows):
    """(id, place, payload, ingested_at) as raw weather rows."""
    data = [
        (i, p, *[Decimal(c) for c in PLACES.get(p, ("0", "0"))], doc, at, "open-meteo") for i, p, doc, at in rows
    ]
    return spark.createDataFrame(data, RAW_WEATHER)


def locations(spark):
    data = [
        (i, name, Decimal(lat), Decimal(lon), "US", "", name, NOW, NOW)
        for i, (name, (lat, lon)) in enumerate(PLACES.items(), start=1)
    ]
    return spark.createDataFrame(data, LOCATION)


def hours_of(spark, *rows, on_error="entity"):
    good, rejects = weather.parse_weather(raw_rows(spark, *rows), locations(spark), on_error)
    ordered = good.orderBy("location_id", "pos").collect()
    return ordered, {(r.entity, r.reason) for r in rejects.collect()}


def test_aligned_hours_are_converted(spark):
    good, rejects = hours_of(spark, (1, "Boston", payload(), NOW))
    assert [g.observed_at.hour for g in good] == [0, 1, 2, 3] and not rejects
    assert good[0].wind_speed_mps == Decimal("3.47") and good[0].temperature_celsius == Decimal("3.50")
    assert good[0].obs_month == dt.date(2024, 11, 1) and good[0].raw_ref.raw_id == 1


@pytest.mark.parametrize(
    ("temps", "want"),
    [
        ([1.0], [1, None, None, None]),
        ([1.0, 2.0, 3.0, 4.0, 5.0], [1, 2, 3, 4]),
        ("absent", [None] * 4),
        (None, [None] * 4),
        ([1.0, None, 3.0, 4.0], [1, None, 3, 4]),
    ],
)
def test_ragged_arrays(spark, temps, want):
    good, rejects = hours_of(spark, (1, "Boston", payload(temperature_2m=temps), NOW))
    assert [g.temperature_celsius for g in good] == want and not rejects


@pytest.mark.parametrize(
    ("doc", "reason"),
    [
        (None, "no_payload"),
        ("", "no_payload"),
        ("{}", "no_hourly"),
        ('{"hourly": {}}', "no_hourly"),
        ('{"hourly": {"time": []}}', "no_time"),
        ("not json", "no_hourly"),
        (payload(times=["2024-11-08T00:00", "later"]), "bad_time"),
        (payload(times=["2024"]), "bad_time"),
        (payload(temperature_2m=["warm", 1, 2, 3]), "bad_value"),
        (payload(windspeed_10m=[99999.0, 1, 2, 3]), "overflow"),
    ],
)
def test_a_bad_payload_is_rejected_alone(spark, doc, reason):
    good, rejects = hours_of(spark, (1, "Boston", doc, NOW), (2, "Chicago", payload(), NOW))
    assert {g.location_id for g in good} == {2} and rejects == {("Boston", reason)}


def test_row_mode_drops_only_the_bad_hour(spark):
    doc = payload(temperature_2m=[1, "x", 3, 4])
    good, rejects = hours_of(spark, (1, "Boston", doc, NOW), on_error="row")
    assert [g.pos for g in good] == [0, 2, 3] and rejects == {("Boston", "bad_value")}


def test_unknown_location_and_newest_payload(spark):
    good, rejects = hours_of(
        spark,
        (1, "Boston", payload(temperature_2m=[1, 1, 1, 1]), NOW),
        (2, "Boston", payload(temperature_2m=[2, 2, 2, 2]), NOW + dt.timedelta(hours=1)),
        (3, "Nowhere", payload(), NOW),
    )
    assert {g.temperature_celsius for g in good} == {2} and rejects == {("Nowhere", "unknown_location")}


def test_offsets_are_moved_to_utc(spark):
    local, _ = hours_of(spark, (1, "Boston", payload(times=["2024-11-08T00:00"], offset=-18000), NOW))
    zoned, _ = hours_of(spark, (1, "Boston", payload(times=["2024-11-08T00:00Z"], offset=-18000), NOW))
    assert (local[0].observed_at.hour, zoned[0].observed_at.hour) == (5, 0)


def test_repeated_hour_and_rerun(spark):
    doc = payload(times=["2024-12-31T23:00", "2024-12-31T23:00", "2025-01-01T00:00"], temperature_2m=[1, 2, 3])
    good, _ = weather.parse_weather(raw_rows(spark, (1, "Boston", doc, NOW)), locations(spark))
    empty = spark.createDataFrame([], WEATHER)
    once = weather.upsert_weather(empty, good, NOW)
    twice = weather.upsert_weather(once, good, NOW + dt.timedelta(days=1))
    for fact in (once, twice):
        rows = fact.orderBy("observed_at").collect()
        assert [r.temperature_celsius for r in rows] == [2, 3]
        assert [r.obs_month for r in rows] == [dt.date(2024, 12, 1), dt.date(2025, 1, 1)]
        assert {r.created_at for r in rows} == {NOW}


def test_run_metrics(spark):
    raw = raw_rows(
        spark,
        (1, "Boston", payload(), NOW),
        (2, "Chicago", payload(times=["?"]), NOW),
        (3, "Nowhere", payload(), NOW),
    )
    row = weather.run_metrics(weather.parse_once(raw, locations(spark))).first()
    assert row.asDict() == {
        "payloads": 3,
        "rejected": 2,
        "applied": 1,
        "locations_processed": 1,
        "rows_applied": 4,
    }


# Pages


def page_doc(page_id, title, revision, **more):
    return json.dumps({"pageid": page_id, "title": title, "revision": revision, **more})


def landed_pages(spark, *docs):
    return spark.createDataFrame(
        [("asked", "en", d, 10) for d in docs],
        "page_title string, page_language string, payload string, content_size int",
    )


def test_page_envelope_falls_back(spark):
    df = landed_pages(
        spark,
        page_doc(7, "T", "1", namespace={"id": 4}, timestamp="2024-11-08T12:00:00Z"),
        page_doc(8, "U", 2, namespace=3),
        "{}",
    )
    rows = landing.page_envelope(df, NOW).orderBy("page_id").collect()
    assert [(r.page_id, r.page_title, r.namespace, r.revision_id) for r in rows] == [
        (0, "asked", 0, ""),
        (7, "T", 4, "1"),
        (8, "U", 3, "2"),
    ]
    assert [r.revision_timestamp for r in rows] == [NOW, dt.datetime(2024, 11, 8, 12), NOW]


def test_rename_and_missing_size(spark):
    def raw(i, title, at):
        return (i, 7, title, 0, str(i), None, None, "en", page_doc(7, title, str(i)), at, "s")

    later = NOW + dt.timedelta(hours=1)
    df = spark.createDataFrame([raw(1, "Old", NOW), raw(2, "New", later)], RAW_PAGES)
    batch = pages.parse_pages(pages.latest_pages(df), NOW)
    row = batch.first()
    assert batch.count() == 1
    assert (row.page_title, row.content_len, row.revision_timestamp) == ("New", 0, NOW)
    by_title = pages.latest_pages(df, ("page_title", "page_language"))
    assert by_title.count() == 2


# Quality


def fact_rows(spark, *rows):
    """(location_id, hour, temperature, humidity, wind)"""
    data = [
        {
            "location_id": loc,
            "observed_at": NOW + dt.timedelta(hours=h),
            "temperature_celsius": None if t is None else Decimal(t),
            "humidity_percent": Decimal(hum),
            "wind_speed_mps": Decimal(w),
            "obs_month": dt.date(2024, 11, 1),
        }
        for loc, h, t, hum, w in rows
    ]
    return spark.createDataFrame(data, WEATHER)


def verdicts(df):
    return {r.name: (r.evaluated, r.unexpected, r.success) for r in df.collect()}


def test_weather_suite(spark):
    sound = [(1, h, -50 if h == 0 else 60, 0, 200) for h in range(19)]
    fact = fact_rows(spark, *sound, (1, 19, 61, 100, 0), (2, 0, None, 50, 1))
    lines = verdicts(quality.checkpoint(fact, quality.weather_suite(locations(spark)), "c"))
    assert lines["temperature_celsius_in_range"] == (20, 1, True)
    assert lines["humidity_percent_in_range"] == (21, 0, True)
    assert lines["unique_location_id_observed_at"] == (21, 0, True)
    assert lines["min_rows_per_location_id"] == (2, 0, True)
    assert lines["wind_speed_mps_exists"] == (1, 0, True)
    worse = fact.unionByName(fact_rows(spark, (1, 0, 99, 50, 1)))
    lines = verdicts(quality.checkpoint(worse, quality.weather_suite(locations(spark)), "c"))
    assert lines["temperature_celsius_in_range"] == (21, 2, False)
    assert lines["unique_location_id_observed_at"] == (22, 2, False)


def test_revision_suite_finds_orphans_and_empty_content(spark):
    rows = [{"page_id": p, "revision_id": "1", "content_len": n} for p, n in ((1, 5), (2, 0), (3, 7))]
    revision = spark.createDataFrame(rows, REVISION)
    dim = spark.createDataFrame([(1,), (2,)], "page_id long")
    results = quality.checkpoint(revision, quality.revision_suite(dim), "c")
    lines = verdicts(results)
    assert lines["content_len_positive"] == (3, 1, False)
    assert lines["page_id_in_dimension"] == (3, 1, False)
    assert lines["unique_page_id_revision_id"] == (3, 0, True)
    assert quality.missing_references(revision, dim, "page_id").first().page_id == 3
    row = quality.summary(results).first()
    assert (row.success, row.unsuccessful_expectations) == (False, 2)
    with pytest.raises(quality.DataQualityError, match="page_id_in_dimension"):
        quality.enforce(results)


def test_required_columns_and_empty_batch(spark):
    df = spark.createDataFrame([], "location_id long, observed_at timestamp_ntz, temperature_celsius double")
    lines = verdicts(quality.checkpoint(df, quality.weather_suite(), "c"))
    assert lines["humidity_percent_exists"] == (1, 1, False)
    assert lines["temperature_celsius_in_range"] == (0, 0, True)
    assert lines["unique_location_id_observed_at"] == (0, 0, True)


# Shapes and storage


def test_evolution_can_run_again(spark):
    df = spark.createDataFrame([(1, "a")], "id long, size string")
    script = dict(rename={"size": "content_len"}, retype={"id": "string"}, add={"note": "string"},
                  backfill={"note": F.lit("n")})
    once = evolve(df, **script)
    assert once.schema == evolve(once, **script).schema
    assert once.first().asDict() == {"id": "1", "content_len": "a", "note": "n"}


def test_contract_report(spark):
    df = conform(spark.createDataFrame([(1, None)], "id long, payload string"), RAW_WEATHER).drop("source")
    report = {r.column_name: (r.ok, r.null_count) for r in contract_report(df, RAW_WEATHER).collect()}
    assert report["id"] == (True, 0) and report["payload"] == (True, 1) and report["source"] == (False, None)


def test_versions_appear_only_when_complete(spark, tmp_path):
    path = str(tmp_path / "mart")
    df = spark.range(3)
    assert tables.read_version(spark, path, df.schema).count() == 0
    assert tables.write_version(df, path) == 1
    # The next version is computed from the one it replaces.
    assert tables.write_version(tables.read_version(spark, path, df.schema).union(df), path) == 2
    (tmp_path / "mart" / "v=3").mkdir()
    assert tables.versions(spark, path) == [1, 2]
    assert tables.read_version(spark, path, df.schema).count() == 6
    assert tables.write_version(df, path) == 4
    assert tables.expire_versions(spark, path, keep=2) == [1]


def test_months_are_replaced_one_by_one(spark, root):
    wh = Warehouse(spark, root)

    def month_rows(*hours):
        rows = [{"location_id": 1, "observed_at": h, "temperature_celsius": Decimal(t)} for h, t in hours]
        return tables.with_month(spark.createDataFrame(rows, WEATHER).drop("obs_month"), "observed_at")

    nov, dec = dt.datetime(2024, 11, 30, 23), dt.datetime(2024, 12, 1)
    november, december = dt.date(2024, 11, 1), dt.date(2024, 12, 1)
    wh.replace_months("core.weather", month_rows((nov, 1), (dec, 2)), [november, december])
    wh.replace_months("core.weather", month_rows((dec, 3)), [december])
    read = lambda: {r.observed_at: r.temperature_celsius for r in wh.read("core.weather").collect()}
    assert read() == {nov: 1, dec: 3}
    # The table is read and overwritten in one go; a month left empty goes away.
    wh.replace_months("core.weather", wh.read("core.weather", [november]).filter("false"), [november])
    assert read() == {dec: 3}


def test_partition_filter_is_used(spark, root):
    wh = Warehouse(spark, root)
    wh.replace_months("core.weather", fact_rows(spark, (1, 0, 1, 1, 1)), [dt.date(2024, 11, 1)])
    plan = reads.recent_observations(wh.read("core.weather"), NOW.date())._jdf.queryExecution().toString()
    scan = plan[plan.rindex("PartitionFilters") :]
    assert "obs_month" in scan[: scan.index("PushedFilters")] and "GreaterThanOrEqual(observed_at" in scan


# Runs


def seed_pair(spark):
    return seeds.seed_frames(
        spark,
        [{"name": n, "latitude": float(lat), "longitude": float(lon)} for n, (lat, lon) in PLACES.items()],
        [{"title": "Boston"}, {"title": "Cardinals", "language": "de"}],
    )


def weather_landing(spark, **docs):
    rows = [(n, *[Decimal(c) for c in PLACES[n]], d) for n, d in docs.items()]
    return spark.createDataFrame(
        rows, "location_name string, latitude decimal(10,8), longitude decimal(11,8), payload string"
    )


def test_seeds_from_a_file_match_inline_defaults(spark, tmp_path):
    path = tmp_path / "seeds.json"
    path.write_text(json.dumps({"locations": [{"name": "A", "latitude": 1.5, "longitude": 2.5}],
                                "wikipedia_pages": [{"title": "A"}, {"title": "B", "language": "fr"}]}))
    places, titles = seeds.read_seeds(spark, str(path))
    place = seeds.location_defaults(places).first()
    assert (place.country, place.region, place.city, place.latitude) == ("US", "", "A", Decimal("1.5"))
    got = [tuple(r) for r in seeds.page_defaults(titles).orderBy("position").collect()]
    assert got == [(0, "A", "en", 0), (1, "B", "fr", 0)]
    places, titles = seeds.inline_seeds(spark)
    assert (places.count(), titles.count()) == (10, 4)


def test_daily_run_end_to_end(spark, root):
    landed = weather_landing(spark, Boston=payload(), Chicago=payload())
    page = landed_pages(spark, page_doc(7, "Boston", "1"), "")
    run = dict(weather_landing=landed, page_landing=page, seeds=seed_pair(spark))
    first = daily.run_daily(spark, root, NOW, **run).first()
    assert (first.weather_rows_applied, first.revisions_inserted, first.views_refreshed) == (8, 1, 2)

    wh = Warehouse(spark, root)
    placeholders = wh.read("core.wikipedia_page").filter("wikipedia_page_id < 0").orderBy("page_title").collect()
    assert [(p.wikipedia_page_id, p.page_title, p.is_current) for p in placeholders] == [
        (-2, "Boston", False),
        (-3, "Cardinals", True),
    ]
    assert [(r.source_table, r.reason) for r in wh.read("raw.rejects").collect()] == [("wikipedia_pages", "no_payload")]
    facts = wh.read("core.weather").select(*schemas.WEATHER_KEY, "created_at").collect()
    again = daily.run_daily(spark, root, NOW + dt.timedelta(hours=1), **run).first()
    assert (again.weather_rows_applied, again.revisions_inserted) == (8, 0)
    assert sorted(facts) == sorted(wh.read("core.weather").select(*schemas.WEATHER_KEY, "created_at").collect())

    # A renamed page opens a version; the fact keeps the surrogate of its time.
    later = NOW + dt.timedelta(hours=2)
    renamed = landed_pages(spark, page_doc(7, "Boston, Massachusetts", "2"))
    daily.run_daily(spark, root, later, page_landing=renamed)
    versions = wh.read("core.wikipedia_page").filter("wikipedia_page_id = 7").orderBy("valid_from").collect()
    assert [(v.page_title, v.is_current, v.valid_to) for v in versions] == [
        ("Boston", False, later),
        ("Boston, Massachusetts", True, None),
    ]
    assert {r.page_id for r in wh.read("core.revision").collect()} == {v.page_id for v in versions}

    mart = wh.read("mart.daily_weather_aggregates").orderBy("location_name").collect()
    assert [(m.location_name, m.observation_count, m.avg_temperature_celsius) for m in mart] == [
        ("Boston", 4, 4.875),
        ("Chicago", 4, 4.875),
    ]

    # Refreshing only the days of one month gives the same mart.
    status = daily.refresh_marts(wh, [dt.date(2024, 11, 1)])
    assert {r["status"] for r in status} == {"success"}
    assert wh.read("mart.daily_weather_aggregates").orderBy("location_name").collect() == mart

    # A batch that fails the gate leaves the marts as they were.
    hot = weather_landing(spark, Boston=payload(temperature_2m=[99, 99, 99, 99]))
    with pytest.raises(quality.DataQualityError, match="temperature_celsius_in_range"):
        daily.run_daily(spark, root, NOW + dt.timedelta(hours=3), weather_landing=hot)
    assert wh.read("mart.daily_weather_aggregates").orderBy("location_name").collect() == mart

    assert {p.page_title for p in daily.core_models(wh)["wikipedia_page"].collect()} == {
        "Boston, Massachusetts",
        "Cardinals",
    }
    names = wh.register("t_")
    assert "t_core.weather" in names
    joined = spark.sql(
        "select l.location_name, count(*) n from t_core.weather w join t_core.location l"
        " on w.location_id = l.location_id group by 1 order by 1"
    )
    assert [tuple(r) for r in joined.collect()] == [("Boston", 4), ("Chicago", 4)]

    check = reports.lineage_check(
        wh.read("raw.weather_observations"),
        wh.read("raw.wikipedia_pages"),
        wh.read("core.weather"),
        wh.read("core.revision"),
        wh.read("mart.daily_weather_aggregates"),
        wh.read("mart.daily_wikipedia_page_stats"),
        NOW.date(),
    )
    assert [r.row_count for r in check.collect()] == [5, 5, 8, 2, 2, 2]

    place, hours, summary = reads.city_report(
        wh.read("core.location"), wh.read("core.weather"), wh.read("raw.wikipedia_pages"), "Boston"
    )
    assert (place.count(), hours.count(), summary.first().title) == (1, 4, "Boston")
    info, recent, stats = reads.location_weather(
        wh.read("core.location"), wh.read("core.weather"), place.first().location_id, NOW.date()
    )
    assert (info.first().location_name, recent.count(), stats.first()["count"]) == ("Boston", 4, 4)


def test_failed_refresh_is_reported(spark, root):
    def broken():
        raise ValueError("no such column")

    wh = Warehouse(spark, root)
    status = daily.refresh_mart(wh, "mart.daily_weather_aggregates", broken)
    assert status["status"] == "failed" and "no such column" in status["error"]


def test_incremental_equals_one_batch_in_any_order(spark, root):
    docs = [
        (1, payload(temperature_2m=[1, 1, 1, 1]), NOW),
        (2, payload(times=HOURS[:2], temperature_2m=[2, 2]), NOW + dt.timedelta(hours=1)),
        (3, payload(times=HOURS[1:3], temperature_2m=[3, 3]), NOW + dt.timedelta(hours=2)),
    ]

    tied = [(4, payload(temperature_2m=[4, 4, 4, 4]), NOW), (5, payload(times=["?"]), NOW), (6, payload(times=HOURS[2:]), NOW)]

    def run(folder, arrivals, apply, files=1):
        wh = Warehouse(spark, folder)
        wh.replace("core.location", locations(spark))
        for batch in arrivals:
            rows = raw_rows(spark, *[(i, "Boston", d, at) for i, d, at in batch])
            wh.append("raw.weather_observations", rows.repartition(files))
            apply(wh, folder)
        fact = wh.read("core.weather").orderBy("observed_at").collect()
        rejects = sorted((r.raw_id, r.reason) for r in wh.read("raw.rejects").collect())
        return [(r.observed_at.hour, int(r.temperature_celsius), r.raw_ref.raw_id) for r in fact], rejects

    def stream(wh, folder):
        run_incremental(wh, f"{folder}/state", NOW, files_per_batch=1)

    def batch(wh, _):
        daily.transform_weather(wh, NOW)

    orders = {
        "together": ([docs], ([(1, 3, 3), (2, 3, 3)], [])),
        "one by one": ([[d] for d in docs], ([(0, 2, 2), (1, 3, 3), (2, 3, 3), (3, 1, 1)], [])),
        "newest first": ([[docs[2]], [docs[0]], [docs[1]]], ([(1, 3, 3), (2, 3, 3)], [])),
        "ties": ([tied], ([(2, 3, 6), (3, 4, 6)], [])),
        "ties, the bad one newest": ([tied[:2]], ([], [(5, "bad_time")])),
    }
    for k, (arrivals, want) in enumerate(orders.values()):
        assert run(f"{root}-{k}-batch", arrivals, batch) == want
        assert run(f"{root}-{k}-stream", arrivals, stream, files=3) == want


def test_rejects_are_recorded_once(spark, root):
    wh = Warehouse(spark, root)
    wh.replace("core.location", locations(spark))
    wh.append("raw.weather_observations", raw_rows(spark, (1, "Boston", payload(times=["?"]), NOW), (2, "Nowhere", "x", NOW)))
    seen = []
    for _ in range(3):
        daily.transform_weather(wh, NOW)
        seen.append(sorted((r.raw_id, r.reason) for r in wh.read("raw.rejects").collect()))
    assert seen == [[(1, "bad_time"), (2, "no_hourly")]] * 3


def test_seeds_listed_twice(spark):
    one = {"name": "A", "latitude": 1.5, "longitude": 2.5}
    places, titles = seeds.seed_frames(
        spark, [{**one, "country": "X"}, {**one, "country": "Y"}], [{"title": "T"}, {"title": "T"}, {"title": "U"}]
    )
    dim = spark.createDataFrame([], LOCATION)
    for turn in range(2):
        dim = daily.seeded_locations(dim, places, NOW + dt.timedelta(hours=turn))
        assert [(r.location_id, r.country) for r in dim.collect()] == [(1, "Y")]
    page = daily.seeded_pages(spark.createDataFrame([], PAGE), titles, NOW)
    assert sorted((r.page_title, r.wikipedia_page_id) for r in page.collect()) == [("T", -2), ("U", -3)]
    first, _ = daily.insert_seeds(spark.createDataFrame([], LOCATION), page, (places, titles), NOW)
    assert [r.country for r in first.collect()] == ["X"]


def test_ids_of_closed_placeholders_are_not_given_again(spark):
    page = daily.seeded_pages(spark.createDataFrame([], PAGE), seeds.seed_frames(spark, [], [{"title": "X"}])[1], NOW)
    closed = page.withColumn("is_current", F.lit(False)).withColumn("valid_to", F.col("valid_from"))
    again = daily.seeded_pages(closed, seeds.seed_frames(spark, [], [{"title": "Z"}])[1], NOW)
    assert sorted((r.page_title, r.wikipedia_page_id) for r in again.collect()) == [("X", -2), ("Z", -3)]


def test_pages_without_an_id_are_rejected_and_not_mixed_up(spark, root):
    docs = [json.dumps({"title": t, "revision": "1"}) for t in ("A", "B", "C")]
    wh = Warehouse(spark, root)
    daily.land_pages(wh, landed_pages(spark, *docs, page_doc(7, "D", "1")), NOW)
    for _ in range(2):
        run = daily.transform_pages(wh, NOW)
        assert run["pages_processed"] == 1
        rejects = wh.read("raw.rejects").collect()
        assert sorted((r.entity, r.reason) for r in rejects) == [(t, "no_page_id") for t in "ABC"]


def test_limit_of_recent_hours_is_per_location(spark):
    fact = fact_rows(spark, *[(k, h, 1, 50, 1) for k in (1, 2) for h in range(5)])
    got = reads.recent_observations(fact, NOW.date(), limit=3).collect()
    assert sorted((r.location_id, r.observed_at.hour) for r in got) == [(k, NOW.hour + h) for k in (1, 2) for h in range(3)]


def test_mart_merges_locations_that_share_a_name(spark):
    fact = fact_rows(spark, (1, 0, 10, 50, 1), (2, 0, 20, 50, 1))
    fact = fact.withColumn("conditions", F.when(F.col("location_id") == 1, "rain"))
    place = locations(spark).withColumn("location_name", F.lit("X")).withColumn("city", F.lit("X"))
    row = marts.daily_weather_aggregates(fact, place).first()
    assert (row.observation_count, row.avg_temperature_celsius, row.most_common_conditions) == (2, 15.0, "rain")
    assert row.avg_wind_speed_kmh == pytest.approx(3.6) and row.avg_pressure_hpa is None


def test_mart_streams_after_its_shuffle(spark):
    """The merge by name keeps a task's rows once, in one sort: no hash table of them, no second sort."""
    fact = fact_rows(spark, (1, 0, 10, 50, 1), (1, 1, 11, 50, 1), (2, 0, 20, 50, 1), (2, 1, 23, 50, 1), (2, 2, 26, 50, 1))
    fact = fact.withColumn("conditions", F.when(F.col("location_id") == 1, "sun").when(F.hour("observed_at") == NOW.hour, "rain"))
    same = {c: F.substring(c, 1, 0) for c in ("location_name", "city")}  # no literals: the plan would fold them
    place = locations(spark).withColumns(same)
    mart = marts.daily_weather_aggregates(fact, place)
    row = mart.first()
    assert (row.observation_count, row.avg_temperature_celsius, row.most_common_conditions) == (5, 18.0, "sun")
    plan = mart._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("REPARTITION_BY_COL")]
    assert "HashAggregate" not in above and above.count("- Sort [") == 1


def test_lookup_upsert_leaves_updated_at(spark):
    later = NOW + dt.timedelta(days=1)
    found = locations(spark).select(*schemas.LOCATION_KEY, "country", "region", F.lit("New").alias("city"))
    rows = daily.upsert_location(locations(spark), found, later).collect()
    assert {(r.city, r.updated_at) for r in rows} == {("New", NOW)}
    seeded = daily.seeded_locations(locations(spark), seed_pair(spark)[0], later).collect()
    assert {(r.city, r.updated_at) for r in seeded} == {("Boston", later), ("Chicago", later)}


def test_first_load_leaves_existing_rows_alone(spark):
    empty = spark.createDataFrame([], LOCATION), spark.createDataFrame([], schemas.PAGE)
    place, page = daily.insert_seeds(*empty, seeds.inline_seeds(spark), NOW)
    assert sorted(r.wikipedia_page_id for r in page.collect()) == [-4, -3, -2, -1]
    again = daily.insert_seeds(place, page, seeds.inline_seeds(spark), NOW + dt.timedelta(days=1))
    for old, new in zip((place, page), again, strict=True):
        assert sorted(map(repr, old.collect())) == sorted(map(repr, new.collect()))


def test_landing_files_with_nested_payloads(spark, tmp_path):
    line = {"location_name": "Boston", "latitude": 42.3601, "longitude": -71.0589, "payload": json.loads(payload())}
    (tmp_path / "landed.json").write_text(json.dumps(line) + "\n")
    df = landing.read_landing(spark, str(tmp_path / "landed.json"), landing.WEATHER_LANDING)
    raw = landing.with_raw_ids(landing.weather_envelope(df, NOW), spark.createDataFrame([], RAW_WEATHER))
    good, _ = weather.parse_weather(raw, locations(spark))
    assert good.count() == 4 and raw.first().source == "open-meteo"


def test_request_window_has_nine_dates():
    start, end = landing.request_window(NOW)
    assert (start, (end - start).days) == (dt.datetime(2024, 11, 7), 9)


# Stored tables


def months_of(spark, *days):
    rows = [{"location_id": i, "observed_at": d, "temperature_celsius": Decimal(i)} for i, d in enumerate(days)]
    return tables.with_month(conform(spark.createDataFrame(rows, "location_id bigint, observed_at timestamp_ntz, temperature_celsius decimal(5,2)"), WEATHER), "observed_at")


def files_of(wh, month):
    fs, path = tables.file_system(wh.spark, f"{wh.path('core.weather')}/obs_month={month}")
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def test_stored_ranges_are_deleted_replaced_and_archived(spark, root):
    days = [dt.datetime(2024, m, d) for m in (9, 10, 11, 12) for d in (1, 15)]
    wh = Warehouse(spark, root)
    wh.replace_months("core.weather", months_of(spark, *days), [d.date().replace(day=1) for d in days])
    before = {m: files_of(wh, f"2024-{m:02}-01") for m in (9, 10, 11, 12)}
    stored = lambda: sorted(r.observed_at for r in wh.read("core.weather").collect())

    assert wh.delete_range("core.weather", "observed_at", days[3], days[4]) == [dt.date(2024, 10, 1)]
    assert stored() == [*days[:3], *days[4:]]
    batch = conform(months_of(spark, dt.datetime(2024, 11, 2), dt.datetime(2024, 11, 3)), WEATHER)
    wh.replace_range("core.weather", batch, "observed_at", days[4], days[6])
    assert stored() == [*days[:3], dt.datetime(2024, 11, 2), dt.datetime(2024, 11, 3), *days[6:]]
    assert files_of(wh, "2024-09-01") == before[9] and files_of(wh, "2024-12-01") == before[12]
    assert files_of(wh, "2024-10-01") != before[10]

    assert wh.archive_before("core.weather", dt.date(2024, 10, 20), f"{root}/old") == [dt.date(2024, 9, 1)]
    assert stored()[0] == days[2] and files_of(wh, "2024-12-01") == before[12]
    assert sorted(r.observed_at for r in spark.read.parquet(f"{root}/old").collect()) == days[:2]
    assert wh.archive_before("core.weather", dt.date(2024, 10, 20), f"{root}/old") == []


def test_old_raw_rows_are_dropped(spark, root):
    wh = Warehouse(spark, root)
    wh.append("raw.weather_observations", raw_rows(spark, (1, "Boston", "x", NOW), (2, "Boston", "y", NOW + dt.timedelta(days=2))))
    wh.delete_loaded_before("raw.weather_observations", NOW + dt.timedelta(days=1))
    assert [r.id for r in wh.read("raw.weather_observations").collect()] == [2]


def test_a_location_without_new_rows_does_not_stop_the_run(spark, root):
    """Boston alone is fetched as a month begins; Chicago has its rows of the month before."""
    first = weather_landing(spark, Boston=payload(), Chicago=payload())
    daily.run_daily(spark, root, NOW, weather_landing=first, seeds=seed_pair(spark))
    december = [t.replace("-11-08", "-12-01") for t in HOURS]
    later = weather_landing(spark, Boston=payload(times=december))
    status = daily.run_daily(spark, root, NOW + dt.timedelta(days=23), weather_landing=later).first()
    assert status.run_status == "success" and status.quality_passed
    wh = Warehouse(spark, root)
    assert all(len(tables.versions(spark, wh.path(n))) <= 2 for n in ("core.location", "core.wikipedia_page", *daily.MARTS))


def test_staged_folders_have_an_owner(spark):
    df = spark.range(3)
    with session.staging(spark):
        inner = session.stage(df, "inner")
        path = inner.inputFiles()[0].rsplit("/", 1)[0]
        assert inner.count() == 3 and tables.path_exists(spark, path)
    assert not tables.path_exists(spark, path)
    loose = session.stage(df, "loose").inputFiles()[0].rsplit("/", 1)[0]
    session._remove([loose])
    assert not tables.path_exists(spark, loose)
