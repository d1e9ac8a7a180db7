"""Landing, coverage, gates, refresh, run log, reports, retention, streaming."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.operators import coverage, keyed, retention
from panelmill.plans import gates, runlog
from panelmill.plans.refresh import refresh
from panelmill.session import scratch_dir
from panelmill.sources import landing, payload, reports
from panelmill.sources.versions import VersionedTable
from panelmill.streaming.snapshots import refresh_stream

from .conftest import rows

SOURCE = "feed"


def batch(spark, *changes, years=(2000, 2001)):
    base = {
        "country_name": "Alpha", "country_code": "AAA", "region": "North", "income_group": "High",
        "gdp_usd": "100.5", "population": "10", "life_expectancy": "70", "unemployment_rate": "5",
        "co2_emissions_per_capita": "1", "access_to_electricity_pct": "99",
        "source_file": SOURCE, "ingested_at": "2026-08-18 04:12:07",
    }
    data = [base | {"year": str(y)} for y in years]
    for record, change in zip(data, changes):
        record.update(change)
    return spark.createDataFrame(
        [tuple(r[c] for c in fixed.SOURCE_COLUMNS) for r in data], landing.text_schema(fixed.SOURCE_COLUMNS)
    )


def codes(spark):
    return spark.createDataFrame([("AAA",), ("BBB",)], "country_code string")


def failure(spark, staged, expected=2):
    report = gates.gate_report(staged, codes(spark), SOURCE, 2000, 2023)
    return gates.first_failure(report, expected).first()["message"]


@pytest.mark.parametrize(
    "change, message",
    [
        ({}, None),
        ({"country_code": "ZZZ"}, fixed.MESSAGE_IDENTITY),
        ({"country_code": None}, fixed.MESSAGE_IDENTITY),
        ({"year": "2000.0"}, fixed.MESSAGE_IDENTITY),
        ({"source_file": None}, fixed.MESSAGE_IDENTITY),
        ({"ingested_at": "infinity"}, fixed.MESSAGE_IDENTITY),
        ({"ingested_at": "2026"}, fixed.MESSAGE_IDENTITY),
        ({"gdp_usd": " "}, fixed.MESSAGE_VALUES),
        ({"gdp_usd": "NaN"}, fixed.MESSAGE_VALUES),
        ({"gdp_usd": "5d"}, fixed.MESSAGE_VALUES),
        ({"unemployment_rate": "101"}, fixed.MESSAGE_RANGES),
        ({"population": "0"}, fixed.MESSAGE_RANGES),
        ({"population": "10.5"}, fixed.MESSAGE_RANGES),
        ({"population": "9223372036854775808"}, fixed.MESSAGE_RANGES),
        ({"year": "1999"}, fixed.MESSAGE_RANGES),
        ({"year": "2001"}, fixed.MESSAGE_DUPLICATE),
        ({"year": "2001", "unemployment_rate": "101"}, fixed.MESSAGE_RANGES),
    ],
)
def test_first_failing_gate(spark, change, message):
    assert failure(spark, batch(spark, change)) == message


def test_row_gate_goes_first(spark):
    assert failure(spark, batch(spark, {"gdp_usd": ""}), 720) == "Expected 720 staging rows"
    assert failure(spark, batch(spark).limit(0), None) == "Expected some staging rows"


def test_refresh_is_all_or_nothing(spark):
    table = VersionedTable(spark, scratch_dir(spark, "typed"), "year")
    log = runlog.RunLog(spark, scratch_dir(spark, "runs"))

    def run(staged, expected=2):
        return refresh(staged, table, log, codes(spark), SOURCE, 2000, 2023, expected, "test")

    run(batch(spark))
    before = table.read()
    with pytest.raises(gates.GateFailure, match=fixed.MESSAGE_RANGES):
        run(batch(spark, {"unemployment_rate": "101"}))
    assert keyed.tables_equal(before, table.read())
    run(batch(spark, {"gdp_usd": "7"}, years=(2001, 2002)))
    assert [(r[0], float(r[1])) for r in rows(table.read(), "year", "gdp_usd")] == [(2000, 100.5), (2001, 7.0), (2002, 100.5)]
    # Only the periods of the last batch were written anew.
    versions = {part.split("/")[1]: part.split("/")[0] for part in table.current().parts}
    assert versions["year=2001"] == versions["year=2002"] != versions["year=2000"]
    runs = log.runs().orderBy("started_ns").collect()
    assert [(r["status"], r["staging_rows"], r["typed_rows"], r["error_message"]) for r in runs] == [
        (fixed.SUCCEEDED, 2, 2, None),
        (fixed.FAILED, None, None, fixed.MESSAGE_RANGES),
        (fixed.SUCCEEDED, 2, 3, None),
    ]
    assert all(r["finished_ns"] >= r["started_ns"] for r in runs)
    assert runlog.last_runs(log.runs(), 1).first()["typed_rows"] == 3


def test_published_is_never_logged_as_failed(spark, monkeypatch):
    base = scratch_dir(spark, "unlogged")
    table, log = VersionedTable(spark, f"{base}/panel"), runlog.RunLog(spark, f"{base}/log")

    def lost(*_):
        raise OSError("the log cannot be written")

    monkeypatch.setattr(log, "succeed", lost)
    with pytest.raises(OSError, match="cannot be written"):
        refresh(batch(spark), table, log, codes(spark), SOURCE, 2000, 2023, 2)
    assert table.read().count() == 2
    assert [r["status"] for r in log.runs().collect()] == [fixed.RUNNING]


def test_run_state_ignores_events_after_the_end(spark):
    log = runlog.RunLog(spark, scratch_dir(spark, "runs"))
    run = log.start("p")
    assert log.runs().first()["status"] == fixed.RUNNING
    log.succeed(run, "p", 1, 1)
    log.fail(run, "p", "late")
    state = log.runs().first()
    assert (state["status"], state["error_message"]) == (fixed.SUCCEEDED, None)


def test_stream_of_snapshots(spark):
    base = scratch_dir(spark, "snapshots")
    landing.write_text(batch(spark).coalesce(1), f"{base}/2026-01-01_000000_000000Z")
    landing.write_text(
        batch(spark, {"gdp_usd": "8"}, years=(2001, 2002)).coalesce(1), f"{base}/2026-01-02_000000_000000Z"
    )
    table = VersionedTable(spark, scratch_dir(spark, "typed"))
    log = runlog.RunLog(spark, scratch_dir(spark, "runs"))
    args = (spark, base, table, log, codes(spark), SOURCE, 2000, 2023, 2, scratch_dir(spark, "checkpoint"))
    refresh_stream(*args).awaitTermination()
    assert table.read().count() == 3
    refresh_stream(*args).awaitTermination()
    assert log.runs().count() == 2


def test_stream_takes_a_folder_of_several_files_as_one_snapshot(spark):
    base = scratch_dir(spark, "snapshots")
    landing.write_text(batch(spark).repartition(2, "year"), f"{base}/2026-01-01_000000_000000Z")
    landing.write_text(batch(spark, years=(2003, 2003)).repartition(2), f"{base}/2026-01-02_000000_000000Z")
    assert retention.list_files(spark, base, "*.csv").count() > 2
    table = VersionedTable(spark, scratch_dir(spark, "typed"))
    log = runlog.RunLog(spark, scratch_dir(spark, "runs"))
    args = (spark, base, table, log, codes(spark), SOURCE, 2000, 2023, 2, scratch_dir(spark, "checkpoint"))
    for failures in (1, 2):
        with pytest.raises(Exception, match=fixed.MESSAGE_DUPLICATE):
            refresh_stream(*args).awaitTermination()
        states = [r["status"] for r in log.runs().collect()]
        assert sorted(states) == sorted([fixed.SUCCEEDED] + [fixed.FAILED] * failures)
        assert rows(table.read(), "year") == [(2000,), (2001,)]


def test_landing_round_trip_and_malformed_files(spark):
    path = scratch_dir(spark, "csv")
    odd = batch(spark, {"country_name": ' a "quoted", name ', "region": "", "gdp_usd": None})
    landing.write_text(odd, path)
    assert keyed.tables_equal(landing.read_text_landing(spark, path), odd)
    bad = scratch_dir(spark, "csv")
    spark.createDataFrame([(",".join(fixed.SOURCE_COLUMNS),), ("a,b",)], "value string").coalesce(1).write.text(bad)
    with pytest.raises(Exception, match="MALFORMED"):
        landing.read_text_landing(spark, bad).collect()


def test_snapshot_choice(spark):
    base = scratch_dir(spark, "snapshots")
    for day, gdp in (("01", "1"), ("03", "3"), ("02", "2")):
        landing.write_text(batch(spark, {"gdp_usd": gdp}, years=(2000,)), f"{base}/2026-01-{day}_000000_000000Z")
    assert landing.read_snapshot(spark, base).first()["gdp_usd"] == "3"
    assert landing.read_snapshot(spark, base, "2026-01-02_000000_000000Z").first()["gdp_usd"] == "2"
    with pytest.raises(PySparkException):
        landing.read_snapshot(spark, base, "2026-02-02_000000_000000Z").collect()


def test_record_ids_without_a_key(spark):
    ids = landing.with_record_id(spark.range(0, 1000, 1, 7).toDF("x")).select("raw_record_id").collect()
    assert len({r[0] for r in ids}) == 1000


def test_schema_contract(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert landing.check_schema(df, {"x": "int", "y": "string"}) == []
    assert landing.check_schema(df, {"x": "bigint", "z": "string"}) == [
        "missing column z", "unexpected column y", "column x is int, expected bigint",
    ]
    assert landing.check_schema(df, {"y": "string", "x": "int"}) == ["columns are in another order"]


def test_fingerprint_sees_values_and_multiplicity(spark):
    a = spark.createDataFrame([(1, None), (2, "b")], "x int, y string")
    prints = [tuple(landing.fingerprint(f).first()) for f in (a, a.orderBy(F.desc("x")), a.union(a), a.fillna("c"))]
    assert prints[0] == prints[1] and len(set(prints)) == 3
    assert a.select(landing.row_json(a)).first()[0] == '{"x":1,"y":null}'


def test_coverage(spark):
    # Entity q: a zero, a missing value, nothing for the last period, one period too many.
    data = [("m", "q", 11, 0), ("m", "q", 12, None), ("m", "q", 14, 3), ("m", "stranger", 11, None)]
    long_df = spark.createDataFrame(data, "indicator string, entity string, year int, value int")
    entities = spark.createDataFrame([("q",), ("r",)], "code string")
    got = {r["indicator"]: r.asDict() for r in coverage.coverage(long_df, entities, "code", 11, 13, ["m", "n"]).collect()}
    assert got["m"] == {"indicator": "m", "expected": 6, "available": 1, "unexpected": 2, "missing": 5}
    assert got["n"] == {"indicator": "n", "expected": 6, "available": 0, "unexpected": 0, "missing": 6}
    lacking = coverage.missing_list(long_df, entities, "code", 11, 13, ["m"])
    assert rows(lacking, "entity", "year") == [("q", 12), ("q", 13), ("r", 11), ("r", 12), ("r", 13)]
    with pytest.raises(ValueError):
        coverage.coverage(long_df, entities, "code", 13, 11, ["m"])
    sets = coverage.cell_sets(long_df, entities, "code", 11, 13).first().asDict()
    assert sets == {"common": 2, "only_present": 2, "only_expected": 4}


def test_flatten_pages(spark):
    def row(code, date, value):
        return f'{{"indicator":{{"id":"i"}},"countryiso3code":{code},"date":"{date}","value":{value}}}'

    pages = spark.createDataFrame(
        [
            (1, f'[{{"page":1}},[{row(chr(34) + "A" + chr(34), 2000, 1)},{row(chr(34) * 2, 2000, 9)}]]'),
            (2, f'[{{"page":2}},[{row(chr(34) + "A" + chr(34), 2000, 2)},{row(chr(34) + "A" + chr(34), 2000, "null")}]]'),
            (3, '[{"message":"none"}]'),
            (4, '[{"page":4},null]'),
        ],
        "page int, body string",
    )
    assert [(r[0], r[1], r[2], int(r[3])) for r in rows(payload.flatten_pages(pages))] == [("i", "A", 2000, 2)]


def test_retention(spark):
    months = ["03", "05", "08", "09", "11", "12"]
    names = [f"2025-{m}-17_101500_000042Z" for m in months]
    other = ["readme", "2025-14-17_101500_000042Z", names[0] + ".bak"]
    listing = spark.createDataFrame([(n, "s") for n in names + other], "name string, group string")
    nothing = listing.limit(0)

    def candidates(now, protected=nothing):
        out = retention.retention_candidates(
            listing, fixed.SNAPSHOT_NAME, fixed.SNAPSHOT_FORMAT, now, fixed.SNAPSHOT_DAYS, protected
        )
        return [r[0] for r in rows(out, "name")]

    def utc(*parts):
        return datetime.datetime(*parts, tzinfo=datetime.timezone.utc)

    assert candidates(utc(2030, 1, 1)) == names[:3]
    assert candidates(utc(2030, 1, 1), listing.where(F.col("name") == names[1])) == [names[0], names[2]]
    assert candidates(utc(2025, 12, 18)) == names[:2]
    # Strictly older: an entry exactly at the cut-off stays.
    edge = utc(2025, 5, 17, 10, 15, 0, 42) + datetime.timedelta(days=fixed.SNAPSHOT_DAYS)
    assert candidates(edge) == names[:1]


def test_report_is_published_only_if_valid(spark):
    base = scratch_dir(spark, "reports")
    columns = ["code", "x"]
    order = [F.desc_nulls_last("x"), F.col("code")]
    good = spark.createDataFrame([("a", 1), ("b", 3), ("c", None)], "code string, x int")
    reports.publish_report(good, base, columns, 3, "code", order)
    # In the order of the part files; a scan may read equally large files in any order.
    read = reports.current_report(spark, base, columns).select("code", F.input_file_name().alias("part")).collect()
    assert [r["code"] for r in sorted(read, key=lambda r: r["part"].rpartition("/")[2])] == ["b", "a", "c"]
    repeated = good.withColumn("code", F.lit("a"))
    with pytest.raises(RuntimeError, match="Expected 3 unique"):
        reports.publish_report(repeated, base, columns, 3, "code", order)
    with pytest.raises(RuntimeError, match="columns"):
        reports.publish_report(good.select("x", "code"), base, columns, 3, "code", order)
    assert reports.current_report(spark, base, columns).where("code = 'b'").count() == 1


def test_upsert_keeps_other_columns_and_takes_null(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    source = spark.createDataFrame([(2, None, "z"), (3, "c", "z")], "k int, v string, w string")
    assert rows(keyed.upsert(target, source, ["k"], ["v"])) == [(1, "a", "x"), (2, None, "y"), (3, "c", "z")]
    assert rows(keyed.upsert_rows(target, source, ["k"])) == [(1, "a", "x"), (2, None, "z"), (3, "c", "z")]
    assert rows(keyed.insert_missing(target, source, ["k"])) == [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]


def test_update_changed_marks_real_changes_only(spark):
    target = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "k int, v int")
    fixes = spark.createDataFrame([(1, 5), (2, 7), (3, 1)], "k int, v int")
    once = keyed.update_changed(target, fixes, ["k"], ["v"])
    assert rows(once) == [(1, 5, False), (2, 7, True), (3, 1, True)]
    again = keyed.update_changed(once.drop("changed"), fixes, ["k"], ["v"])
    assert [r[2] for r in rows(again)] == [False, False, False]


def test_multiset_difference(spark):
    a = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert rows(keyed.multiset_difference(a, b)) == [(1, 2, 1), (2, 0, 1)]
    assert keyed.tables_equal(a, a.orderBy("x"))
