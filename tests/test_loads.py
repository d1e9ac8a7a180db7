"""Concurrent writers, loads that publish everything or nothing, rejected snapshots, clean-up lists."""

import datetime
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.operators import keyed, retention
from panelmill.operators.validate import verify_fixes
from panelmill.plans import gates, load, refresh, runlog
from panelmill.plans.refresh import refresh as run_refresh
from panelmill.session import scratch_dir, stage
from panelmill.sources import commits, landing, payload
from panelmill.sources.versions import Conflict, VersionedSet, VersionedTable, stale_scratch
from panelmill.streaming import snapshots
from panelmill.streaming.snapshots import refresh_stream, rejected_snapshots

from .conftest import rows
from .test_publishing import SOURCE, batch, codes

FIX = "country_code string, year string, column_name string, issue_type string, original_value string, cleaned_value string"


# --- commits ---------------------------------------------------------------------------------


@pytest.mark.parametrize("by_rename", [False, True])
def test_a_file_is_created_once(spark, by_rename, monkeypatch):
    base = scratch_dir(spark, "once")
    if by_rename:
        monkeypatch.setattr(commits, "link_once", lambda path, hidden, text: rename(path, hidden, text))

    def rename(path, hidden, text):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        return commits.rename_once(spark, target.getFileSystem(spark._jsc.hadoopConfiguration()), target, hidden, text)

    assert commits.create_once(spark, f"{base}/1.json", '{"a": 1}')
    assert not commits.create_once(spark, f"{base}/1.json", '{"a": 2}')
    assert commits.create_once(spark, f"{base}/2.json", '{"a": 3}')
    assert sorted(r["a"] for r in spark.read.json(base).collect()) == [1, 3]


def test_one_of_many_threads_creates_the_file(spark):
    base, won = scratch_dir(spark, "once"), []

    def write(n):
        if commits.create_once(spark, f"{base}/1.json", f'{{"a": {n}}}'):
            won.append(n)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and [r["a"] for r in spark.read.json(base).collect()] == won


def test_a_version_made_from_an_older_one_is_refused(spark):
    table = VersionedTable(spark, scratch_dir(spark, "typed"))
    table.overwrite(batch(spark))
    mine = table.write(batch(spark, {"gdp_usd": "1"}), table.current())
    table.overwrite(batch(spark, {"gdp_usd": "2"}))
    with pytest.raises(Conflict, match="version 2"):
        table.publish(mine)
    assert rows(table.read().where("year = '2000'"), "gdp_usd") == [("2",)]
    assert table.current().number == 2 and table.commits().count() == 2


@pytest.mark.parametrize("partition", [None, "year"])
def test_two_refreshes_at_once_lose_nothing(spark, partition):
    base = scratch_dir(spark, "typed")
    table, log = VersionedTable(spark, base, partition), runlog.RunLog(spark, f"{base}-runs")
    run_refresh(batch(spark), table, log, codes(spark), SOURCE, 2000, 2023, 2)
    batches = [batch(spark, {"gdp_usd": str(n)}, years=(2002 + n, 2010 + n)) for n in range(3)]
    errors = []

    def one(staged):
        try:
            run_refresh(staged, VersionedTable(spark, base, partition), log, codes(spark), SOURCE, 2000, 2023, 2)
        except Exception as error:  # noqa: BLE001 - seen by the test
            errors.append(error)

    threads = [threading.Thread(target=one, args=(b,)) for b in batches]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    assert [r[0] for r in rows(table.read(), "year")] == [2000, 2001, 2002, 2003, 2004, 2010, 2011, 2012]
    assert sorted(r["typed_rows"] for r in log.runs().collect()) == [2, 4, 6, 8]


def test_a_refresh_that_keeps_losing_fails_as_a_whole(spark, monkeypatch):
    base = scratch_dir(spark, "typed")
    table, log = VersionedTable(spark, base), runlog.RunLog(spark, f"{base}-runs")
    run_refresh(batch(spark), table, log, codes(spark), SOURCE, 2000, 2023, 2)
    before, write = table.read(), refresh.write_upsert

    def overtaken(target, typed, periods):
        version = write(target, typed, periods)
        target.publish(target.write(target.read(), target.current()))
        return version

    monkeypatch.setattr(refresh, "write_upsert", overtaken)
    with pytest.raises(Conflict):
        run_refresh(batch(spark, years=(2005, 2006)), table, log, codes(spark), SOURCE, 2000, 2023, 2, attempts=2)
    assert keyed.tables_equal(before, table.read())
    assert sorted(r["status"] for r in log.runs().collect()) == [fixed.FAILED, fixed.SUCCEEDED]


@pytest.mark.parametrize("step", ["observed", "key_counts", "cast_panel", "write_upsert"])
def test_a_failure_at_any_step_publishes_nothing(spark, monkeypatch, step):
    base = scratch_dir(spark, "typed")
    table, log = VersionedTable(spark, base), runlog.RunLog(spark, f"{base}-runs")
    run_refresh(batch(spark), table, log, codes(spark), SOURCE, 2000, 2023, 2)
    before = table.current()

    def broken(*_):
        raise OSError(f"{step} broke")

    monkeypatch.setattr(refresh, step, broken)
    with pytest.raises(OSError, match="broke"):
        run_refresh(batch(spark, years=(2005, 2006)), table, log, codes(spark), SOURCE, 2000, 2023, 2)
    assert table.current() == before
    assert runlog.last_runs(log.runs(), 1).first()["error_message"] == f"{step} broke"


def test_partitions_with_odd_values(spark):
    table = VersionedTable(spark, scratch_dir(spark, "odd"), "p")
    first = spark.createDataFrame([(1, "a b"), (2, None), (3, "x=1/2+%")], "v int, p string")
    table.overwrite(first)
    assert rows(table.read(), "v", "p") == rows(first, "v", "p")
    later = table.write(spark.createDataFrame([(4, None), (5, "new")], "v int, p string"), table.current(), keep=True)
    table.publish(later)
    assert rows(table.read(), "v") == [(1,), (3,), (4,), (5,)] and later.rows == 4
    assert rows(table.in_partitions(table.read(), [None, "a b"]), "v") == [(1,), (4,)]


def test_folders_that_no_commit_names(spark):
    base = scratch_dir(spark, "typed")
    table, log = VersionedTable(spark, base, "year"), runlog.RunLog(spark, f"{base}-runs")
    for n in range(3):
        run_refresh(batch(spark, {"gdp_usd": str(n)}, years=(2000, 2001 + n)), table, log, codes(spark), SOURCE, 2000, 2023, 2)
    lost = table.write(keyed.cast_panel(batch(spark)), table.current(), keep=True)
    later = datetime.datetime.now(datetime.timezone.utc) + datetime.timedelta(days=10)
    assert table.unreachable().isEmpty()  # all of them are young
    gone = {r["folder"] for r in table.unreachable(keep=1, now=later).collect()}
    live = set(table.current().parts)
    assert not gone & live and set(lost.parts) - live <= gone
    # Year 2000 was written three times, and once more by the version that was never published.
    assert sum(f.endswith("year=2000") for f in gone) == 3
    stage(batch(spark), "old")
    assert stale_scratch(spark, now=later).where("folder LIKE 'old-%'").count() >= 1
    assert stale_scratch(spark).where("folder LIKE 'old-%'").isEmpty()


# --- stream ----------------------------------------------------------------------------------


def test_a_rejected_snapshot_is_passed_by(spark):
    base = scratch_dir(spark, "snapshots")
    good, other = batch(spark), batch(spark, {"gdp_usd": "8"}, years=(2002, 2003))
    landing.write_text(good.coalesce(1), f"{base}/2026-01-01_000000_000000Z")
    landing.write_text(batch(spark, {"unemployment_rate": "101"}).coalesce(1), f"{base}/2026-01-02_000000_000000Z")
    text = spark.createDataFrame([("not,the,header",), ("1,2,3",)], "value string")
    text.coalesce(1).write.text(f"{base}/2026-01-03_000000_000000Z/csv")
    # Spark's text writer has no csv ending: give the folder a file that the stream looks at.
    header = spark.createDataFrame([(",".join(fixed.SOURCE_COLUMNS),), ("a,b",)], "value string")
    header.coalesce(1).write.option("compression", "none").text(f"{base}/plain")
    files = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    Path = spark._jvm.org.apache.hadoop.fs.Path
    part = next(s.getPath() for s in files.listStatus(Path(f"{base}/plain")) if s.getPath().getName().startswith("part"))
    files.mkdirs(Path(f"{base}/2026-01-04_000000_000000Z"))
    files.rename(part, Path(f"{base}/2026-01-04_000000_000000Z/panel.csv"))
    landing.write_text(other.coalesce(1), f"{base}/2026-01-05_000000_000000Z")
    table, log = VersionedTable(spark, scratch_dir(spark, "typed")), runlog.RunLog(spark, scratch_dir(spark, "runs"))
    noted = scratch_dir(spark, "rejected")

    def start():
        refresh_stream(
            spark, base, table, log, codes(spark), SOURCE, 2000, 2023, 2, scratch_dir(spark, "checkpoint"), noted
        ).awaitTermination()

    start()
    assert [r[0] for r in rows(table.read(), "year")] == [2000, 2001, 2002, 2003]
    aside = {r["snapshot"][:10]: r["message"] for r in rejected_snapshots(spark, noted).collect()}
    assert set(aside) == {"2026-01-02", "2026-01-04"} and aside["2026-01-02"] == fixed.MESSAGE_RANGES
    # A new checkpoint brings every file again: nothing is published, tried or noted twice.
    runs, commits_before = log.runs().count(), table.commits().count()
    start()
    assert (log.runs().count(), table.commits().count(), rejected_snapshots(spark, noted).count()) == (runs, commits_before, 2)


def test_a_crash_after_the_commit_publishes_nothing_twice(spark, monkeypatch):
    base = scratch_dir(spark, "snapshots")
    landing.write_text(batch(spark).coalesce(1), f"{base}/2026-01-01_000000_000000Z")
    landing.write_text(batch(spark, years=(2004, 2005)).coalesce(1), f"{base}/2026-01-02_000000_000000Z")
    table, log = VersionedTable(spark, scratch_dir(spark, "typed")), runlog.RunLog(spark, scratch_dir(spark, "runs"))
    args = (spark, base, table, log, codes(spark), SOURCE, 2000, 2023, 2, scratch_dir(spark, "checkpoint"))
    whole = snapshots.refresh

    def crash(*given, **named):
        whole(*given, **named)
        raise OSError("the driver is lost")

    monkeypatch.setattr(snapshots, "refresh", crash)
    with pytest.raises(Exception, match="driver is lost"):
        refresh_stream(*args).awaitTermination()
    assert table.commits().count() == 1
    monkeypatch.setattr(snapshots, "refresh", whole)
    refresh_stream(*args).awaitTermination()
    assert table.commits().count() == 2 and table.read().count() == 4


# --- extract ---------------------------------------------------------------------------------


def page(*cells, code="gdp_usd"):
    rows = ",".join(f'{{"indicator":{{"id":"{code}"}},"countryiso3code":"{e}","date":"{y}","value":{v}}}' for e, y, v in cells)
    return f'[{{"page":1}},[{rows}]]'


def extracted(spark, bodies, path):
    pages = spark.createDataFrame(list(enumerate(bodies)), "page int, body string")
    wanted = spark.createDataFrame([(c, c, 0) for c in fixed.INDICATORS], "indicator string, code string, rank int")
    entities = spark.createDataFrame([("AAA",), ("BBB",)], "country_code string")
    info = spark.createDataFrame([("AAA", "Alpha", "North", "High")], "country_code string, country_name string, region string, income_group string")
    return load.extract_snapshot(pages, wanted, entities, info, 2000, 2001, path, SOURCE)


def test_extract_to_snapshot(spark):
    path = scratch_dir(spark, "snapshot")
    bodies = [page(("AAA", 2000, 1.5), ("BBB", 2001, "null")), page(("AAA", 2000, 2)), page(("AAA", 2001, 0), code="population"), '[{"message":"none"}]']
    report = {r["indicator"]: (r["expected"], r["available"], r["missing"]) for r in extracted(spark, bodies, path).collect()}
    assert report["gdp_usd"] == (4, 1, 3) and report["population"] == (4, 1, 3) and report["life_expectancy"] == (4, 0, 4)
    got = landing.read_text_landing(spark, path)
    shown = [(r["country_name"], r["year"], r["gdp_usd"] and float(r["gdp_usd"])) for r in got.orderBy("country_code", "year").collect()]
    assert shown == [("Alpha", "2000", 2.0), ("Alpha", "2001", None), ("BBB", "2000", None), ("BBB", "2001", None)]


@pytest.mark.parametrize(
    "bad, message",
    [
        (page(("AAA", 2009, 1)), "unexpected cells of gdp_usd: 1"),
        (page(("ZZZ", 2000, 1)), "unexpected cells of gdp_usd: 1"),
        (page(("AAA", 2000, 1))[:-7], "malformed page: 1"),
        ('[{"page":1},{"rows":1}]', "malformed page: 1"),
        (page(("AAA", "20x", 1)), "unreadable period: 1"),
        (page(("AAA", 2000, '"many"')), "unreadable value: 1"),
        (page(("AAA", 2000, "9" * 30)), "unreadable value: 1"),
        ('[{"page":1},[null,5]]', "malformed row: 2"),
    ],
)
def test_extract_stops_before_anything_is_written(spark, bad, message):
    path = scratch_dir(spark, "snapshot")
    with pytest.raises(gates.GateFailure, match=message):
        extracted(spark, [page(("AAA", 2000, 1)), bad], path)
    assert not commits.exists(spark, path)


def test_flatten_raises_on_the_first_problem(spark):
    pages = spark.createDataFrame([(1, page(("AAA", 2000, 1))), (2, page(("AAA", "20x", 1)))], "page int, body string")
    with pytest.raises(PySparkException, match="unreadable period on page 2"):
        payload.flatten_pages(pages).collect()
    good, rejected = payload.split_pages(pages)
    assert good.count() == 1 and rows(rejected) == [(2, 0, "unreadable period")]
    assert payload.entries(pages)._jdf.queryExecution().optimizedPlan().toString().count("parse_json") <= 1


def test_pages_are_cast_once_and_cells_hashed(spark):
    values = ["1.5", "true", '"2"', "[1]", "null", '"x"', "1e3"]
    pages = [(2**62, page(("AAA", 2000, 1), ("AAA", 2000, 2))), (None, page(("AAA", 2000, 9), ("BBB", 2000, 4), ("BBB", 2000, 5))), (-(2**63), page(("BBB", 2000, 3)))]
    df = stage(spark.createDataFrame(pages, "page bigint, body string"), "pages")
    got = payload.flatten_pages(df)
    assert [(e, float(v)) for e, v in rows(got, "entity", "value")] == [("AAA", 2.0), ("BBB", 3.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "schema_of_variant" not in plan
    odd = payload.entries(spark.createDataFrame([(k, page(("AAA", 2000, v))) for k, v in enumerate(values)], "page int, body string"))
    seen = [(p, v and float(v)) for _, v, p in rows(odd, "page", "value", "problem")]
    assert seen == [(None, 1.5), (None, 1.0), (None, 2.0), (payload.BAD_VALUE, None), (None, None), (payload.BAD_VALUE, None), (None, 1000.0)]
    named = payload.flatten_pages(spark.createDataFrame([("b", page(("AAA", 2000, 1))), ("a", page(("AAA", 2000, 2)))], "page string, body string"))
    assert float(named.first()["value"]) == 1


# --- clean track and maintenance -------------------------------------------------------------


def raw_panel(spark, *changes):
    staged = batch(spark, *changes)
    return staged.select((F.col("year").substr(-4, 4).cast("int") - 1999).cast("bigint").alias("raw_record_id"), *fixed.SOURCE_COLUMNS)


def dimension(spark):
    return spark.createDataFrame([("AAA", "Alpha", "North", "High")], "country_code string, country_name string, region string, income_group string")


def table_set(spark):
    base = scratch_dir(spark, "tables")
    return VersionedSet(spark, base, [load.CLEAN, load.AUDIT]), runlog.RunLog(spark, f"{base}-runs")


def test_clean_load_publishes_both_tables_or_none(spark):
    tables, log = table_set(spark)
    dim = dimension(spark)
    load.load_clean(raw_panel(spark, {"gdp_usd": "-1"}), dim, tables, log, 2000, 2023)
    first = tables.current()
    assert (tables.rows(load.CLEAN, first), tables.rows(load.AUDIT, first)) == (2, 1)
    assert tables.read(load.CLEAN).where("cleaned_at IS NULL").isEmpty()
    # A year that its correction brings out of the period ends the load.
    wrong = raw_panel(spark).withColumn("year", F.when(F.col("year") == "2001", "FY2109").otherwise(F.col("year")))
    with pytest.raises(gates.GateFailure, match="outside the accepted range: 1"):
        load.load_clean(wrong, dim, tables, log, 2000, 2023)
    assert tables.current() == first and tables.read(load.AUDIT).count() == 1
    twice = raw_panel(spark).withColumn("raw_record_id", F.lit(1).cast("bigint"))
    with pytest.raises(gates.GateFailure):
        load.load_clean(twice, dim, tables, log, 2000, 2023)
    assert tables.current() == first
    assert sorted(r["status"] for r in log.runs().collect()) == [fixed.FAILED, fixed.FAILED, fixed.SUCCEEDED]


def test_documented_fixes_are_applied_all_or_none_and_once(spark):
    tables, log = table_set(spark)
    raw = raw_panel(spark, {"life_expectancy": "7.5"}, {"gdp_usd": "$12"})
    load.load_clean(raw, dimension(spark), tables, log, 2000, 2023)
    before, times = tables.current(), rows(tables.read(load.CLEAN), "raw_record_id", "cleaned_at")
    good = [("AAA", "2000", "life_expectancy", "decimal", "7.5", "75.0"), ("AAA", "2001", "gdp_usd", "unit", "$12", "12000000")]
    missing = [*good, ("AAA", "2001", "life_expectancy", "decimal", "6.9", "69")]
    for wrong in (missing, [*good, ("BBB", "2000", "gdp_usd", "unit", "1", "2")], [*good, ("AAA", "2000", "life_expectancy", "other", "7.5", "76")]):
        with pytest.raises(gates.GateFailure):
            load.apply_fixes(spark.createDataFrame(wrong, FIX), raw, tables, log)
        assert tables.current() == before
    fixes = spark.createDataFrame(good, FIX)
    with pytest.raises(gates.GateFailure, match="raw rows"):
        load.apply_fixes(fixes, raw, tables, log, load.Expected(raw_rows=3))
    load.apply_fixes(fixes, raw, tables, log, load.Expected(2, 2))
    clean = tables.read(load.CLEAN)
    assert [(float(a), float(b)) for a, b in rows(clean, "life_expectancy", "gdp_usd")] == [(70.0, 12000000.0), (75.0, 100.5)]
    after = rows(clean, "raw_record_id", "cleaned_at")
    assert all(new > old for (_, old), (_, new) in zip(times, after, strict=True))
    log_rows = rows(tables.read(load.AUDIT), "raw_record_id", "issue_type", "original_value", "cleaned_value")
    assert (1, "decimal", "7.5", "75.0") in log_rows and (2, "unit", "$12", "12000000") in log_rows
    logged = rows(tables.read(load.AUDIT), "raw_record_id", "issue_type", "logged_at")
    load.apply_fixes(fixes, raw, tables, log)
    assert rows(tables.read(load.CLEAN), "raw_record_id", "cleaned_at") == after
    assert rows(tables.read(load.AUDIT), "raw_record_id", "issue_type", "logged_at") == logged


def test_no_table_of_the_panel_is_broadcast_to_apply_fixes(spark):
    tables, log = table_set(spark)
    raw = stage(raw_panel(spark, {"life_expectancy": "7.5"}), "raw")
    load.load_clean(raw, dimension(spark), tables, log, 2000, 2023)
    clean, audit = tables.read(load.CLEAN), tables.read(load.AUDIT)
    # Shuffled like a derived table of corrections; its own side is never the one that travels in a left join.
    fixes = spark.createDataFrame([("AAA", "2000", c, "decimal", "7.5", "75.0") for c in ("life_expectancy", "unknown", None)], FIX)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        found = load.targets(fixes, clean, raw)
        checked = verify_fixes(fixes, clean, raw, audit)
        for df in (found, checked):
            assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()
        # Only the corrections' own few rows may travel, and the audit log's not.
        logged = load.relogged(audit, stage(found, "found"))._jdf.queryExecution().executedPlan().toString()
        assert logged.count("BroadcastExchange") <= 1
        assert [(r["column_name"], r["sound"]) for r in found.orderBy("column_name").collect()] == [(None, False), ("life_expectancy", True), ("unknown", False)]
        seen = [(r["column_name"], r["raw_value"], r["cleaned_value"] and float(r["cleaned_value"]), r["passed"]) for r in checked.orderBy("column_name").collect()]
        assert seen == [(None, None, None, False), ("life_expectancy", "7.5", 7.5, False), ("unknown", None, None, False)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_number_is_lost_without_an_audit_row(spark):
    values = ["4" * 24, "4" * 30, "4" * 38, "$" + "4" * 30, "-" + "4" * 30, "0" * 30 + "7", "1,5"]
    years = range(2000, 2000 + len(values))
    raw = batch(spark, *[{"gdp_usd": v} for v in values], years=years).withColumn("raw_record_id", F.col("year").cast("bigint") - 1999)
    tables, log = table_set(spark)
    load.load_clean(raw.select("raw_record_id", *fixed.SOURCE_COLUMNS), dimension(spark), tables, log, 2000, 2023)
    got = {r["raw_record_id"]: r["gdp_usd"] for r in tables.read(load.CLEAN).collect()}
    assert [got[n] is None for n in range(1, 8)] == [True] * 5 + [False, False] and float(got[6]) == 7
    found = rows(tables.read(load.AUDIT).where("column_name = 'gdp_usd'"), "raw_record_id", "issue_type")
    assert found == [
        (1, fixed.OVERFLOW), (2, fixed.OVERFLOW), (3, fixed.OVERFLOW), (4, fixed.FORMAT_STANDARDIZED), (4, fixed.OVERFLOW), (5, fixed.OUT_OF_RANGE),
    ]


# --- keyed history, ids, folders -------------------------------------------------------------


def test_history(spark):
    def at(day):
        return F.lit(f"2024-01-0{day} 00:00:00")

    start = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    history = keyed.begin_history(start, ["k"], ["v"], at(1))
    change = spark.createDataFrame([(1, "b"), (2, None), (3, None), (4, "d")], "k int, v string")
    once = keyed.track_changes(history, change, ["k"], ["v"], at(2))
    again = keyed.track_changes(once, change, ["k"], ["v"], at(3))
    shown = [(r["k"], r["v"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day) for r in again.orderBy("k", "valid_from").collect()]
    assert shown == [(1, "a", 1, 2), (1, "b", 2, None), (2, None, 1, None), (3, "c", 1, 2), (3, None, 2, None), (4, "d", 2, None)]
    back = keyed.track_changes(again, start, ["k"], ["v"], at(4))
    assert back.where("k = 1").count() == 3 and back.where("valid_to IS NULL").count() == 4


def test_ids_are_dense_and_stay(spark):
    landed = landing.with_record_id(spark.range(0, 1000, 1, 7).where("id % 3 = 0").toDF("x"))
    first = rows(landed, "raw_record_id", "x")
    assert sorted(r[0] for r in first) == list(range(1, 335)) and rows(landed, "raw_record_id", "x") == first
    assert landing.with_record_id(spark.range(0).toDF("x")).isEmpty()


def test_folders_with_other_content_stay(spark):
    names = [f"2025-0{m}-17_101500_000042Z" for m in range(1, 9)]
    held = {0: ["panel.csv"], 1: ["panel.csv", "notes.txt"], 2: ["sub/panel.csv"], 3: ["other.csv"], 4: ["panel.csv"]}
    files = [(f"{n}/{f}",) for i, n in enumerate(names) for f in held.get(i, ["panel.csv"])] + [("panel.csv",), ("old/panel.csv",)]
    listing = spark.createDataFrame(files, "path string")
    now = datetime.datetime(2030, 1, 1, tzinfo=datetime.timezone.utc)

    def gone(*protected):
        shields = spark.createDataFrame([(p,) for p in protected], "path string")
        found = retention.tree_candidates(listing, fixed.SNAPSHOT_NAME, fixed.SNAPSHOT_FORMAT, now, 180, shields, "panel.csv")
        return [r[0] for r in rows(found, "name")]

    assert gone() == [names[0], names[4]]
    assert gone(f"{names[0]}/deep/er/file") == [names[4]] and gone(names[4]) == [names[0]]
