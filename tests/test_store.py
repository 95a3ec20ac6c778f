"""Month folders, raw batches, refreshes and bounded runs: what survives a job that dies, and what a run reads."""

import datetime as dt
import json
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataflow.operators import merge, scd
from strataflow.operators.shape import evolve
from strataflow.plans import daily, marts, pages, quality, refresh
from strataflow.schemas import LOCATION, RAW_PAGES, RAW_WEATHER, REVISION, WEATHER, WEATHER_DAYS
from strataflow.sources import files, ingest, months, tables
from strataflow.sources import lookup as lookup_module
from strataflow.sources.tables import Warehouse
from strataflow.streaming.incremental import run_incremental

NOW = dt.datetime(2024, 3, 9, 6)
FACT, RAW, PAGES = "core.weather", "raw.weather_observations", "raw.wikipedia_pages"


class Died(Exception):
    pass


def dies(*_, **__):
    raise Died


def hours(spark, *rows):
    """(location, time, temperature)"""
    data = [{"location_id": k, "observed_at": at, "temperature_celsius": Decimal(t), "humidity_percent": Decimal(50),
             "wind_speed_mps": Decimal(1)} for k, at, t in rows]
    return tables.with_month(spark.createDataFrame(data, WEATHER).drop("obs_month"), "observed_at")


def stored(wh, name=FACT):
    return sorted((r.location_id, r.observed_at, int(r.temperature_celsius)) for r in wh.read(name).collect())


def plan_of(df):
    return df._jdf.queryExecution().toString()


def at(month, day=1, hour=0):
    return dt.datetime(2024, month, day, hour)


# Month folders


def test_archive_twice_keeps_every_row(spark, root):
    wh, old = Warehouse(spark, root), f"{root}-old"
    ten = [(1, at(1, 1, h), h) for h in range(10)]
    wh.replace_months(FACT, hours(spark, *ten, (1, at(3), 1)), [dt.date(2024, 1, 1), dt.date(2024, 3, 1)])
    assert wh.archive_before(FACT, dt.date(2024, 3, 1), old) == [dt.date(2024, 1, 1)]
    # A late row of the archived month, and a correction of a row that is in the archive.
    late = [(2, at(1, 5), 7), (1, at(1, 1, 3), 33)]
    wh.replace_months(FACT, hours(spark, *late), [dt.date(2024, 1, 1)])
    assert wh.archive_before(FACT, dt.date(2024, 3, 1), old) == [dt.date(2024, 1, 1)]
    archive = months.MonthTable(spark, old, WEATHER)
    got = sorted((r.location_id, r.observed_at, int(r.temperature_celsius)) for r in archive.read().collect())
    assert got == sorted([r for r in ten if r[1] != at(1, 1, 3)] + late)
    assert stored(wh) == [(1, at(3), 1)]
    assert wh.archive_before(FACT, dt.date(2024, 3, 1), old) == []


@pytest.mark.parametrize("step", ["rows", "switch", "detach"])
def test_archive_that_dies_can_be_repeated(spark, root, monkeypatch, step):
    wh, old = Warehouse(spark, root), f"{root}-old"
    rows = [(1, at(1, d), d) for d in range(1, 6)]
    wh.replace_months(FACT, hours(spark, *rows), [dt.date(2024, 1, 1)])
    with monkeypatch.context() as m:
        if step == "detach":  # the archive has switched, the table is about to
            switch, calls = months.MonthTable._switch, []
            m.setattr(months.MonthTable, "_switch", lambda self, s: dies() if calls else calls.append(1) or switch(self, s))
        else:
            m.setattr(months.MonthTable, "_write" if step == "rows" else "_switch", dies)
        with pytest.raises(Died):
            wh.archive_before(FACT, dt.date(2024, 2, 1), old)
    assert stored(wh) == rows
    wh.archive_before(FACT, dt.date(2024, 2, 1), old)
    assert stored(wh) == [] and months.MonthTable(spark, old, WEATHER).read().count() == 5


def test_replace_that_dies_leaves_the_old_months_and_can_be_repeated(spark, root, monkeypatch):
    wh, two = Warehouse(spark, root), [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    old, new = [(1, at(1), 1), (1, at(2), 2)], [(1, at(1), 10), (1, at(2), 20), (2, at(2), 30)]
    wh.replace_months(FACT, hours(spark, *old), two)
    with monkeypatch.context() as m:
        m.setattr(months.MonthTable, "_switch", dies)  # all rows are written, the marker is not
        with pytest.raises(Died):
            wh.replace_months(FACT, hours(spark, *new), two)
    assert stored(wh) == old and wh.recover() == {}
    wh.replace_months(FACT, hours(spark, *new), two)
    assert stored(wh) == new
    wh.months(FACT).expire(keep=1)  # the dead write's folders go with the old state
    assert stored(wh) == new and len(files.child_names(spark, f"{wh.path(FACT)}/obs_month=2024-02-01")) == 1


def test_switch_that_dies_is_completed(spark, root, monkeypatch):
    wh, month = Warehouse(spark, root), [dt.date(2024, 1, 1)]
    wh.replace_months(FACT, hours(spark, (1, at(1), 1)), month)
    with monkeypatch.context() as m:
        m.setattr(months, "move", dies)
        with pytest.raises(Died):
            wh.replace_months(FACT, hours(spark, (1, at(1), 2), (2, at(1), 3)), month)
    assert stored(wh) == [(1, at(1), 1)]
    assert wh.recover() == {FACT: [2]} and stored(wh) == [(1, at(1), 2), (2, at(1), 3)]
    # One that comes too late, as another writer has switched since, is forgotten.
    with monkeypatch.context() as m:
        m.setattr(months, "move", dies)
        with pytest.raises(Died):
            wh.replace_months(FACT, hours(spark, (1, at(1), 9)), month)
    wh.replace_months(FACT, hours(spark, (1, at(1), 4)), month)
    assert wh.recover() == {} and stored(wh) == [(1, at(1), 4)]


def test_rows_outside_the_months_fail_and_the_slower_writer_too(spark, root):
    wh, month = Warehouse(spark, root), [dt.date(2024, 1, 1)]
    with pytest.raises(Exception, match="outside the months"):
        wh.replace_months(FACT, hours(spark, (1, at(1), 1), (1, at(2), 2)), month)
    assert stored(wh) == []
    table = wh.months(FACT)
    table.replace(hours(spark, (1, at(1), 1)), month)
    with pytest.raises(FileExistsError):
        table._switch(months.State(1))


def test_a_slow_reader_keeps_its_version_over_three_refreshes(spark, root):
    wh, mart = Warehouse(spark, root), "mart.daily_weather_aggregates"

    def publish(n):
        wh.replace("core.location", spark.createDataFrame([(i, f"P{i}") for i in range(n)], "location_id long, location_name string"))
        row = [(f"P{n}", dt.date(2024, 1, 1), n)]
        wh.replace(mart, spark.createDataFrame(row, "location_name string, observation_date date, observation_count long"))

    publish(1)
    with wh.snapshot(mart, "core.location") as held:
        for n in (2, 3, 4):
            publish(n)
            wh.expire(keep=1)
        assert [r.observation_count for r in held[mart].collect()] == [1] and held["core.location"].count() == 1
        assert wh.read(mart).first().observation_count == 4
    gone = wh.expire(keep=1)
    assert 1 in gone[mart] and 1 in gone["core.location"]
    assert wh.read(mart).first().observation_count == 4 and wh.read("core.location").count() == 4


def test_a_lease_runs_out(spark, root):
    wh, month = Warehouse(spark, root), [dt.date(2024, 1, 1)]
    wh.replace_months(FACT, hours(spark, (1, at(1), 1)), month)
    with wh.snapshot(FACT, hours=-1):
        for n in (2, 3):
            wh.replace_months(FACT, hours(spark, (1, at(1), n)), month)
        assert wh.months(FACT).expire(keep=1) == [1, 2]


def test_months_written_under_older_schemas_read_as_one(spark, root):
    v0 = spark.createDataFrame([], "id int, size string, obs_month date").schema
    v2 = spark.createDataFrame([], "id long, content_len int, note string, obs_month date").schema
    v1 = spark.createDataFrame([], "id int, content_len int, obs_month date").schema
    steps = [
        (v0, lambda df: evolve(df, rename={"size": "content_len"}, retype={"content_len": "int"})),
        (v1, lambda df: evolve(df, retype={"id": "bigint"}, add={"note": "string"}, backfill={"note": F.lit("old")})),
    ]
    jan, feb, mar = (dt.date(2024, m, 1) for m in (1, 2, 3))
    months.MonthTable(spark, root, v0).replace(spark.createDataFrame([(1, "10", jan), (2, "20", feb)], v0), [jan, feb])
    months.MonthTable(spark, root, v1, migrations=steps[:1]).replace(spark.createDataFrame([(3, 30, mar)], v1), [mar])
    table = months.MonthTable(spark, root, v2, migrations=steps)
    assert table.read().schema.simpleString() == v2.simpleString()
    assert sorted(table.read().collect()) == [(1, 10, "old", jan), (2, 20, "old", feb), (3, 30, "old", mar)]
    # Rewriting a month brings it to the newest schema; the others stay as they were written.
    table.replace(table.read([feb]).withColumn("note", F.lit("new")), [feb])
    assert sorted(table.read().collect()) == [(1, 10, "old", jan), (2, 20, "new", feb), (3, 30, "old", mar)]
    assert sorted(table.state().schemas.values()) == [0, 1, 2]
    assert sorted(r.id for r in table.read([jan, feb]).collect()) == [1, 2]


# Raw batches


def raw_rows(spark, *rows):
    """(id, place, payload, ingested_at)"""
    return spark.createDataFrame([(i, p, Decimal(1), Decimal(2), doc, when, "s") for i, p, doc, when in rows], RAW_WEATHER)


def doc(*hours_and_values, month=3, **more):
    n = [v for _, v in hours_and_values]
    times = [f"2024-{month:02}-09T{h:02}:00" for h, _ in hours_and_values]
    hourly = {"time": times, "temperature_2m": n, "relativehumidity_2m": [50.0] * len(n), "windspeed_10m": [3.6] * len(n)}
    return json.dumps({"hourly": {**hourly, **more}})


def places(spark, *names):
    rows = [(i, n, Decimal(1), Decimal(2), "US", "", n, NOW, NOW) for i, n in enumerate(names, start=1)]
    return spark.createDataFrame(rows, LOCATION)


def test_batches_newest_rows_and_log(spark, root):
    raw = Warehouse(spark, root).batches(RAW)
    day = dt.timedelta(days=1)
    assert raw.land(raw_rows(spark, (1, "A", "x", NOW), (2, "B", "y", NOW + day), (3, "A", "z", NOW))) == 1
    assert raw.land(raw_rows(spark, (9, "A", "old", NOW - day), (7, "B", None, None))) == 2
    newest = {r.location_name: (r.id, r.b) for r in raw.newest().collect()}
    assert newest == {"A": (3, 1), "B": (7, 2)}  # no time counts as the newest
    assert raw.highest_id() == 9 and raw.batches() == [1, 2] and raw.entry(2)["rows"] == 2
    assert sorted(r.id for r in raw.read(1).collect()) == [7, 9]
    assert sorted(r.id for r in raw.read(1, [1]).collect()) == [1, 2, 3, 7, 9]
    assert raw.land(raw_rows(spark, (1, "A", "x", NOW)).limit(0)) == 3 and raw.highest_id() == 9


@pytest.mark.parametrize("step", ["_settle", "move", "_facts", "write_text"])
def test_landing_that_dies_is_completed_once(spark, root, monkeypatch, step):
    raw = Warehouse(spark, root).batches(RAW)
    raw.land(raw_rows(spark, (1, "A", "x", NOW)))
    rows = raw_rows(spark, (2, "A", "y", NOW + dt.timedelta(days=1)), (3, "B", "z", NOW + dt.timedelta(days=2)))
    with monkeypatch.context() as m:
        m.setattr(ingest.RawTable if step.startswith("_") else ingest, step, dies)
        with pytest.raises(Died):
            raw.land(rows)
    assert raw.recover() == [2] and raw.recover() == []
    assert sorted(r.id for r in raw.read().collect()) == [1, 2, 3] and raw.highest_id() == 3
    assert {r.location_name: r.id for r in raw.newest().collect()} == {"A": 2, "B": 3}


def test_retention_drops_batches_and_survives_a_death(spark, root, monkeypatch):
    raw = Warehouse(spark, root).batches(RAW)
    clock = lambda d, h: dt.datetime(2024, 3, d, h)
    raw.land(raw_rows(spark, (1, "A", "x", clock(1, 5)), (2, "A", "x", clock(2, 1))))
    raw.land(raw_rows(spark, (3, "A", "x", clock(2, 23)), (4, "A", "x", None), (5, "B", "x", clock(2, 2))))
    raw.land(raw_rows(spark, (6, "B", "x", clock(2, 22)), (7, "B", "x", clock(3, 1))))
    raw.land(raw_rows(spark, (9, "B", "x", None)))
    untouched = files.child_names(spark, f"{raw.path}/b=00000003")
    ids = lambda: sorted(r.id for r in raw.read().collect())
    for step in ("write_text", "move", "remove"):  # before the plan is known, before and while folders are changed
        with monkeypatch.context() as m:
            m.setattr(ingest, step, dies)
            with pytest.raises(Died):
                raw.drop_before(clock(2, 12))
        assert set(ids()) >= {3, 4, 6, 7, 9}
    raw.recover()
    assert raw.drop_before(clock(2, 12)) == [1]
    assert ids() == [3, 4, 6, 7, 9] and sorted((r.id, r.b) for r in raw.read(2).collect()) == [(6, 3), (7, 3), (9, 4)]
    assert files.child_names(spark, f"{raw.path}/b=00000003") == untouched
    assert raw.drop_before(clock(2, 23)) == [] and ids() == [3, 4, 7, 9]
    assert raw.land(raw_rows(spark, (8, "B", "x", clock(2, 23)))) == 5 and ids() == [3, 4, 7, 8, 9]


def test_a_micro_batch_reads_no_other_raw_rows(spark, root, monkeypatch):
    wh = Warehouse(spark, root)
    wh.replace("core.location", places(spark, "A", "B"))
    wh.append(RAW, raw_rows(spark, (1, "A", doc((1, 5.0)), NOW), (2, "B", doc((1, 6.0)), NOW)))
    seen = []
    from strataflow.plans import weather

    newest_of = weather.newest_of
    monkeypatch.setattr(weather, "newest_of", lambda b, n: seen.append(newest_of(b, n)) or seen[-1])
    run_incremental(wh, f"{root}/stream", NOW, files_per_batch=1)
    assert seen and stored(wh) == [(1, at(3, 9, 1), 5), (2, at(3, 9, 1), 6)]
    scans = [f for df in seen for f in df.inputFiles()]
    raw_files = [f for f in scans if "/_newest/" not in f]
    assert len(raw_files) <= 2 * len(seen) and all(f"/raw/{RAW.partition('.')[2]}/" in f for f in scans)


# Runs


def landing(spark, **docs):
    rows = [(n, Decimal(1), Decimal(2), d) for n, d in docs.items()]
    return spark.createDataFrame(rows, "location_name string, latitude decimal(10,8), longitude decimal(11,8), payload string")


def page(spark, *rows):
    """(id, title, revision, size)"""
    data = [(t, "en", json.dumps({"pageid": i, "title": t, "revision": r, "timestamp": "2024-03-0" + r + "T00:00:00Z"}), n) for i, t, r, n in rows]
    return spark.createDataFrame(data, "page_title string, page_language string, payload string, content_size int")


def days_of_work(spark):
    """Landed batches of three days: corrections, a place that is unknown at first, a rename, a month's end."""
    return [
        (landing(spark, A=doc((1, 1.0), (2, 2.0)), B=doc((1, 3.0)), C=doc((5, 9.0))), page(spark, (7, "T", "1", 10), (8, "U", "1", 5))),
        (landing(spark, A=doc((2, 22.0), (3, 4.0))), page(spark, (7, "T2", "2", 20))),
        (landing(spark, B=doc((1, 7.0), month=4)), page(spark, (9, "V", "3", 1))),
    ]


def contents(wh):
    dims = wh.read("core.wikipedia_page").drop("page_id")
    facts = [stored(wh), sorted(map(repr, dims.collect()))]
    revisions = wh.read("core.revision").select("revision_id", "content_len", "revision_timestamp")
    facts.append(sorted(map(repr, revisions.collect())))
    facts.append(sorted((r.raw_id, r.reason) for r in wh.read("raw.rejects").collect()))
    return [*facts, *[sorted(map(repr, wh.read(m).collect())) for m in daily.MARTS]]


def run_days(spark, root, **how):
    wh = Warehouse(spark, root)
    wh.replace("core.location", places(spark, "A", "B"))
    for k, (weather_batch, page_batch) in enumerate(days_of_work(spark)):
        if k == 1:  # C gets known; its payload has been waiting
            wh.replace("core.location", places(spark, "A", "B", "C"))
        daily.run_daily(spark, root, NOW + dt.timedelta(days=k), weather_landing=weather_batch, page_landing=page_batch,
                        all_locations=k > 0, **how)
    return wh


@pytest.fixture(scope="module")
def three_days(spark, tmp_path_factory):
    """A warehouse after the three days, to be copied: all names in it are relative to its root."""
    return run_days(spark, str(tmp_path_factory.mktemp("days") / "warehouse")).root


@pytest.fixture
def worked(spark, three_days, root):
    shutil.copytree(three_days, root)
    return Warehouse(spark, root)


def test_bounded_runs_equal_full_ones(spark, worked, root):
    bounded, full = worked, run_days(spark, f"{root}-full", full=True)
    assert contents(bounded) == contents(full)
    rebuilt = [sorted(map(repr, df.collect())) for df in (
        marts.daily_weather_aggregates(bounded.read(FACT), bounded.read("core.location")),
        marts.daily_page_stats(bounded.read("core.revision"), bounded.read("core.wikipedia_page")),
    )]
    assert contents(bounded)[-2:] == rebuilt
    by_name = {r.name: (r.evaluated, r.unexpected) for r in daily.quality_results(bounded).collect()}
    assert by_name == {r.name: (r.evaluated, r.unexpected) for r in daily.quality_results(bounded, full=True).collect()}
    # A run with nothing new applies nothing, and a second look at raw reads no batch that is through.
    again = daily.run_daily(spark, root, NOW + dt.timedelta(days=5)).first()
    assert (again.weather_rows_applied, again.pages_processed, again.run_status) == (0, 0, "success")
    for name in daily.RAW:
        bounded.append(name, bounded.read(name).limit(1))
        df = daily.unapplied(bounded, name)
        assert "PartitionFilters: [isnotnull(b#" in plan_of(df)
        read = {f.rpartition("/b=")[2].partition("/")[0] for f in bounded.batches(name).read(3).inputFiles()}
        assert read <= {f"{b:08d}" for b in bounded.batches(name).batches()}


def test_untouched_months_keep_their_files(spark, worked, root):
    wh = worked
    march, april = dt.date(2024, 3, 1), dt.date(2024, 4, 1)
    before = {n: wh.months(n).state().months for n in (FACT, "state.weather_days", "mart.daily_weather_aggregates")}
    daily.run_daily(spark, root, NOW + dt.timedelta(days=6), weather_landing=landing(spark, B=doc((2, 8.0), month=4)))
    for name, was in before.items():
        now = wh.months(name).state().months
        assert now[march] == was[march] and now[april] != was[april]
    # A delete in the fact reaches the mart as well.
    wh.delete_range(FACT, "observed_at", at(3), at(4))
    assert {r["status"] for r in daily.refresh_marts(wh)} == {"success"}
    assert {r.observation_date.month for r in wh.read(daily.MARTS[0]).collect()} == {4}
    assert wh.stored_months("state.weather_days") == [april]


def test_a_renamed_location_is_renamed_in_all_months(spark, worked, root):
    wh = worked
    new = wh.read("core.location").withColumn("city", F.when(F.col("location_name") == "B", "Bee").otherwise(F.col("city")))
    wh.replace("core.location", new)
    kept = wh.months("mart.daily_weather_aggregates").state().months
    daily.refresh_marts(wh, renames=False)
    assert wh.months("mart.daily_weather_aggregates").state().months == kept
    daily.refresh_marts(wh)
    mart = sorted(map(repr, wh.read(daily.MARTS[0]).collect()))
    assert mart == sorted(map(repr, marts.daily_weather_aggregates(wh.read(FACT), wh.read("core.location")).collect()))


def test_a_failed_gate_is_looked_at_again(spark, root):
    wh = Warehouse(spark, root)
    wh.replace("core.location", places(spark, "A", "B"))
    daily.run_daily(spark, root, NOW, weather_landing=landing(spark, A=doc((1, 1.0)), B=doc((1, 1.0))))
    with pytest.raises(quality.DataQualityError, match="temperature"):
        daily.run_daily(spark, root, NOW, weather_landing=landing(spark, A=doc((1, 99.0))))
    # The month that failed is not touched by the next batch, and fails it all the same.
    with pytest.raises(quality.DataQualityError, match="temperature"):
        daily.run_daily(spark, root, NOW, weather_landing=landing(spark, B=doc((1, 1.0), month=4)))
    good = daily.run_daily(spark, root, NOW + dt.timedelta(hours=1), weather_landing=landing(spark, A=doc((1, 2.0)))).first()
    assert good.run_status == "success" and (1, at(3, 9, 1), 2) in stored(wh)


def test_revision_counts_are_added_up_batch_by_batch(spark, root):
    wh = Warehouse(spark, root)
    wh.replace("core.wikipedia_page", spark.createDataFrame([(1, True), (2, True)], "page_id long, is_current boolean"))
    def batch(*rows):
        data = [{"page_id": p, "revision_id": r, "content_len": n, "fetched_at": NOW} for p, r, n in rows]
        wh.append("core.revision", spark.createDataFrame(data, REVISION))
    for rows in ([(1, "a", 5), (1, "b", 0), (2, "a", 1)], [(1, "a", 2), (1, "c", 4), (1, "c", 4)], [(1, "a", 1), (3, "x", -1), (2, "a", 1)], []):
        if rows:
            batch(*rows)
        added = {r.name: (r.evaluated, r.unexpected, r.success) for r in daily.revision_lines(wh).collect()}
        suite = quality.revision_suite(wh.read("core.wikipedia_page"))
        assert added == {r.name: (r.evaluated, r.unexpected, r.success) for r in quality.checkpoint(wh.read("core.revision"), suite, "c").collect()}
        new = wh.batches("core.revision").read(wh.noted("revision_checks")["batch"])
        assert new.count() == 0


def test_gate_counts_rows_per_location_without_the_fact(spark, worked, root):
    wh = worked
    lines = daily.quality_results(wh, [], all_locations=True)
    assert not [f for f in lines.inputFiles() if "/core/weather/" in f]
    least = {r.name: (r.evaluated, r.unexpected) for r in lines.collect()}["min_rows_per_location_id"]
    assert least == (3, 0)
    wh.replace("core.location", places(spark, "A", "B", "C", "D"))
    with pytest.raises(quality.DataQualityError, match="min_rows"):
        quality.enforce(daily.quality_results(wh, []))


@pytest.mark.parametrize("kind", ["one", "two"])
def test_one_pass_merge_equals_the_function_and_scans_the_dimension_once(spark, root, kind):
    wh, name = Warehouse(spark, root), "core.wikipedia_page"
    rows = [(1, 7, "en", "T", True), (2, 8, "en", "U", True), (3, 8, "en", "old", False), (4, 9, None, "V", True), (5, 9, "de", None, True), (6, 3, "en", "W", None)]
    wh.replace(name, spark.createDataFrame(rows, "page_id long, wikipedia_page_id long, page_language string, page_title string, is_current boolean"))
    batch = spark.createDataFrame(
        [(7, "en", "T2"), (8, "en", "U"), (9, "de", "X"), (10, "en", "new"), (11, "en", None), (3, "en", "again")],
        "wikipedia_page_id long, page_language string, page_title string",
    )
    dim, keys = wh.read(name), ["wikipedia_page_id", "page_language"]
    if kind == "two":
        want = scd.scd2_apply(dim, batch, keys, "page_title", NOW, id_col="page_id", created_cols=["first_seen_at"])
        merged = scd.scd2_merge_rows(dim, batch, keys, "page_title", NOW, id_col="page_id", created_cols=["first_seen_at"])
    else:
        how = dict(id_col="page_id", now=NOW, created_cols=["first_seen_at"], touch_cols=["last_updated_at"])
        want = merge.dim_upsert(dim, batch, keys, ["page_title"], **how)
        merged = merge.dim_merge_rows(dim, batch, keys, ["page_title"], **how)
    scans = [line for line in plan_of(merged).partition("== Physical Plan ==")[2].splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1
    want = want.collect()
    assert wh.merge_dimension(name, merged, "page_id", keys) == 2
    assert sorted(map(repr, wh.read(name).collect())) == sorted(map(repr, want))
    # The highest surrogate is noted with the version; a version that came otherwise is asked for it.
    assert wh.highest_id(name, "page_id") == max(r.page_id for r in want) == wh.noted(f"highest-{name}")["id"]
    wh.replace(name, wh.read(name).filter("page_id < 6"))
    assert wh.highest_id(name, "page_id") == 5
    assert "t2_core.wikipedia_page" in wh.register("t2_") and spark.table("t2_core.wikipedia_page").columns == dim.columns


def test_a_merge_that_dies_leaves_the_dimension_and_is_cleared(spark, root, monkeypatch):
    wh, name = Warehouse(spark, root), "core.wikipedia_page"
    wh.replace(name, spark.createDataFrame([(1, 7, "en", "T", True)], "page_id long, wikipedia_page_id long, page_language string, page_title string, is_current boolean"))
    batch = spark.createDataFrame([(7, "en", "T2"), (8, "en", "U")], "wikipedia_page_id long, page_language string, page_title string")
    merged = pages.merged_pages(wh.read(name), batch, NOW)
    with monkeypatch.context() as m:
        m.setattr(tables, "move", dies)
        with pytest.raises(Died):
            wh.merge_dimension(name, merged, "page_id", ("wikipedia_page_id", "page_language"))
    assert wh.read(name).count() == 1 and [c for c in files.child_names(spark, wh.path(name)) if c.startswith("_merge")]
    assert wh.recover() == {} and files.child_names(spark, wh.path(name)) == ["v=1"]
    assert wh.merge_dimension(name, merged, "page_id", ("wikipedia_page_id", "page_language")) == 2
    assert sorted((r.page_id, r.page_title, r.is_current) for r in wh.read(name).collect())[0] == (1, "T", False) and wh.read(name).count() == 3
    for k in range(4):
        wh.note("x", {"k": k})
    assert wh.noted("x") == {"k": 3} and len(files.child_names(spark, f"{root}/state/_notes/x")) == 2


def test_a_title_reads_few_files(spark, root):
    wh = Warehouse(spark, root)
    def landed(*titles, day=1):
        rows = [{"id": i, "page_title": t, "payload": f"{t}-{day}", "ingested_at": dt.datetime(2024, 3, day)} for i, t in enumerate(titles)]
        wh.append(PAGES, spark.createDataFrame(rows, RAW_PAGES).repartition(3))
    titles = [f"Title {i}" for i in range(300)]
    landed(*titles, "Ünïcode", None)
    assert wh.index_titles() == 1 and wh.index_titles() == 0
    landed("TITLE 7", "title 7", "other", day=2)
    assert wh.index_titles() == 1
    lookup = wh.titles()
    assert sorted(r.payload for r in lookup.find("tItLe 7").collect()) == ["TITLE 7-2", "Title 7-1", "title 7-2"]
    assert lookup.find("ÜNÏCODE").count() == 1 and lookup.find("nowhere").count() == 0
    everything = spark.read.parquet(lookup.path).inputFiles()
    plan = plan_of(lookup.find("Title 7"))
    assert "PartitionFilters: [isnotnull(bucket" in plan
    bucket = spark.range(1).select(lookup_module.bucket_of(F.lit("title 7"))).first()[0]
    mine = [f for f in everything if f"/bucket={bucket}/" in f]
    assert 0 < len(mine) < len(everything) / 10
    # A batch that died while it was added is added again, once.
    files.remove(spark, f"{lookup.path}/_log/00000002")
    assert wh.index_titles() == 1 and lookup.find("title 7").count() == 3


def test_stored_days_have_their_declared_types(spark):
    made = marts.weather_days(spark.createDataFrame([], WEATHER)).schema
    assert [(f.name, f.dataType) for f in made] == [(f.name, f.dataType) for f in WEATHER_DAYS]
    assert refresh.changed_months(months.State(1, {dt.date(2024, 1, 1): "a"}), {"2024-02-01": "b"}) == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    assert RAW_PAGES.names[0] == "id"
