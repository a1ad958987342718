import csv
import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from staffcast.operators import upsert
from staffcast.sinks import tables as sinks
from staffcast.sources import snapshots
from staffcast.sources import tables as sources
from staffcast.sources.schemas import REQUESTS, SALARY
from staffcast.staging import stage, staging_root
from staffcast.streaming.scoring import EVENT_ORDER, read_events, start_scoring
from staffcast.streaming.store import RequestStore

DAY = date(2001, 8, 2)


def test_staged_tables_go_to_the_shared_folder(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(3), "three")
    assert staged.count() == 3 and staged.inputFiles()[0].startswith("file://" + staging_root(spark))


def test_latest_snapshot_ignores_unfinished_ones(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    with pytest.raises(FileNotFoundError):
        snapshots.read_latest(spark, path)
    snapshots.write_snapshot(spark.range(1), path, date(2001, 1, 1))
    snapshots.write_snapshot(spark.range(2), path, date(2001, 1, 2))
    snapshots.write_snapshot(spark.range(3), path, date(2001, 1, 2))
    (tmp_path / "snapshots" / "snapshot_date=2001-01-03").mkdir()
    assert snapshots.snapshot_days(spark, path) == ["2001-01-01", "2001-01-02"]
    assert snapshots.read_latest(spark, path).count() == 3
    assert snapshots.read_as_of(spark, path, date(2001, 1, 1)).count() == 1


def test_replacing_a_day_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "predictions")
    rows = spark.range(4).withColumn("insertion_date", F.lit(DAY))
    assert not sinks.has_day(spark, path, DAY)
    for _ in range(2):
        sinks.replace_day(rows, path, DAY)
    sinks.replace_day(rows.limit(1), path, date(2001, 8, 1))
    assert sinks.has_day(spark, path, DAY) and spark.read.parquet(path).count() == 5
    sinks.replace_day(rows.filter("id < 0"), path, DAY)
    assert not sinks.has_day(spark, path, DAY) and spark.read.parquet(path).count() == 1


def test_replacing_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "parts")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.replace_partitions(df, path, "p")
    sinks.replace_partitions(df.filter("p = 'b'").withColumn("v", F.lit(9)), path, "p")
    assert {(r["v"], r["p"]) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b")}


class Connection:
    """Stands in for a DB-API connection."""

    def __init__(self, fail=False):
        self.log, self.fail, self.rowcount = [], fail, 2

    def cursor(self):
        return self

    def execute(self, statement, values):
        if self.fail:
            raise RuntimeError("no table")
        self.log.append((statement, values))

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_jdbc_replacement_is_one_transaction(spark):
    rows = spark.range(1)
    connection, appended = Connection(), []
    deleted = sinks.replace_day_jdbc(rows, "url", "s.t", {}, DAY, lambda: connection, append=lambda df, url, table, p: appended.append((table, list(connection.log))))
    [(staged, before)] = appended
    assert deleted == 2 and staged.startswith("s.t_") and before == []
    assert connection.log == [
        ("DELETE FROM s.t WHERE insertion_date = %s", ("2001-08-02",)), (f"INSERT INTO s.t (id) SELECT id FROM {staged}", ()),
        "commit", (f"DROP TABLE {staged}", ()), "commit", "close",
    ]
    broken = Connection(fail=True)
    with pytest.raises(RuntimeError):
        sinks.replace_day_jdbc(rows, "url", "t", {}, DAY, lambda: broken, append=lambda *a: None)
    assert broken.log == ["rollback", "close"]
    untouched = Connection()

    def failing(*a):
        raise RuntimeError("append failed")

    with pytest.raises(RuntimeError):
        sinks.replace_day_jdbc(rows, "url", "t", {}, DAY, lambda: untouched, append=failing)
    assert untouched.log == []
    with pytest.raises(ValueError, match="identifier"):
        sinks.replace_day_jdbc(rows, "url", "t; DROP TABLE t", {}, DAY, lambda: untouched, append=failing)


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    texts = ['plain', 'say "yes", then\nstop', 'a, b\r\n"c"', '\\ back "\\"', None]
    with open(tmp_path / "r.csv", "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(["n", "t", "x"])
        writer.writerows([i, t, i / 2] for i, t in enumerate(texts))
    rows = sources.read_csv(spark, str(tmp_path / "r.csv"), "n int, t string, x double").orderBy("n").collect()
    assert [(r.n, r.t.replace("\r\n", "\n") if r.t else r.t, r.x) for r in rows] == [(i, t.replace("\r\n", "\n") if t else t, i / 2) for i, t in enumerate(texts)]
    (tmp_path / "bad.csv").write_text("n,t,x\none,a,1.0\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        sources.read_csv(spark, str(tmp_path / "bad.csv"), "n int, t string, x double").collect()


def test_database_source(spark):
    asked = []

    def read(spark, **options):
        asked.append(options)
        return spark.range(1)

    options = {"url": "u", "properties": {}, "column": "id", "bounds": (0, 9)}
    sources.load_inputs(spark, "jdbc", "requests", "salary", SALARY, database=options, read=read)
    assert [a["table"] for a in asked] == ["requests", "salary"] and asked[0]["bounds"] == (0, 9)
    with pytest.raises(ValueError, match="parallel"):
        sources.load_inputs(spark, "jdbc", "requests", "salary", SALARY, database={"url": "u", "properties": {}}, read=read)


def test_unread_days_are_counted(spark):
    texts = spark.createDataFrame([("soon",), ("2001-08-02",), (None,), ("03/08/2001",)], "need_date string")
    assert sources.unread_days(texts).first() == (1,)


def test_sources(spark, tmp_path):
    salary = spark.createDataFrame([(1.5, DAY, 100, "p", 3, "N", 2)], SALARY)
    salary.write.csv(str(tmp_path / "salary"), header=True)
    requests = spark.createDataFrame([], REQUESTS)
    requests.write.csv(str(tmp_path / "requests"), header=True)
    read = sources.load_inputs(spark, "csv", str(tmp_path / "requests"), str(tmp_path / "salary"), SALARY)
    assert read[1].collect() == salary.collect() and read[0].schema == requests.schema
    with pytest.raises(ValueError):
        sources.load_inputs(spark, "cloud", "", "", SALARY)
    records = spark.createDataFrame([('{"a": 1}',), ('{"b": "x"}',)], "j string")
    assert [tuple(r) for r in sources.parse_records(records, "j", "a int, b string").collect()] == [(1, None), (None, "x")]
    texts = spark.createDataFrame([("2001-08-02", "x")], "need_date string, other string")
    assert sources.parse_days(texts).first() == (DAY, "x")


def test_coalescing_upsert(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 3, "z")], "k string, n int, s string")
    new = spark.createDataFrame([("a", None, "y", 1), ("b", 5, None, 1), ("d", 7, "w", 1)], "k string, n int, s string, extra int")
    want = {("a", 1, "y"), ("b", 5, None), ("c", 3, "z"), ("d", 7, "w")}
    once = upsert.coalescing_upsert(old, new, "k")
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in upsert.coalescing_upsert(once, new, "k").collect()} == want


def test_folding_events_equals_applying_them_in_turn(spark):
    events = [("a", 1, "x", None), ("a", 3, None, 5), ("a", 2, "y", 4), ("b", 1, None, None)]
    df = spark.createDataFrame(events, "k string, at int, s string, n int")
    got = {r["k"]: (r["s"], r["n"]) for r in upsert.fold_events(df, "k", ["at"], ["s", "n"]).collect()}
    assert got == {"a": ("y", 5), "b": (None, None)}


def base_rows(spark):
    rows = [
        ("R1", "Closed", 2, 10.0, "N", "h1", "a1", 8.0, 6.0, 3.0),
        ("R2", "Open", 1, 20.0, "N", "h1", "a2", 10.0, 7.0, 5.0),
        ("R3", "Open", 1, 30.0, "S", "h2", "a2", 40.0, 9.0, None),
    ]
    return spark.createDataFrame(
        rows,
        "request_code string, status string, positions_filled int, community_tech_hours double, region string, "
        "hr_manager string, sales_agent string, applicant_tech_hours_12 double, applicant_tenure double, tech_tenure double",
    ).withColumns(
        {
            "tech_hours": F.lit(1.0), "average_salary": F.lit(2.0), "average_salary_12": F.lit(3.0),
            "change_date": F.lit(None).cast("date"),
        }
    )


def by_key(df):
    return {r["request_code"]: r.asDict() for r in df.collect()}


def test_new_requests_get_defaults_only_where_fields_are_missing(spark, tmp_path):
    store = RequestStore(spark, str(tmp_path / "store"), buckets=4)
    store.create(base_rows(spark))
    medians = store.default_medians()
    events = spark.createDataFrame(
        [("R2", None, None, 99.0, None, 1), ("R9", "N", "h2", None, None, 1), ("R8", "X", None, 5.0, "Closed", 1)],
        "request_code string, region string, hr_manager string, community_tech_hours double, status string, event_time int",
    )
    rows = by_key(store.upsert(events, 0, ["event_time"], medians, DAY))
    assert set(rows) == {"R2", "R8", "R9"}
    assert rows["R2"]["community_tech_hours"] == 99.0 and rows["R2"]["region"] == "N" and rows["R2"]["change_date"] is None
    new = rows["R9"]
    assert new["status"] == "Open" and new["change_date"] == DAY and new["positions_filled"] == 0
    assert (new["community_tech_hours"], new["applicant_tech_hours_12"], new["tech_tenure"]) == (15.0, 40.0, 0.0)
    assert new["applicant_tenure"] == 0.0 and new["average_salary"] == 0.0
    assert rows["R8"]["status"] == "Closed" and rows["R8"]["community_tech_hours"] == 5.0


def test_store_versions_and_repeated_batches(spark, tmp_path):
    store = RequestStore(spark, str(tmp_path / "store"), buckets=4)
    store.create(base_rows(spark))
    medians = store.default_medians()

    def event(code, hours, at):
        return spark.createDataFrame([(code, hours, at)], "request_code string, community_tech_hours double, event_time int")

    store.upsert(event("R1", 1.0, 1), 0, ["event_time"], medians, DAY)
    store.upsert(event("R1", 2.0, 2), 1, ["event_time"], medians, DAY)
    store.upsert(event("R7", 4.0, 3), 2, ["event_time"], medians, DAY)
    store.upsert(event("R1", 2.0, 2), 1, ["event_time"], medians, DAY)  # repeated after a failure
    now = by_key(store.rows())
    assert len(now) == 4 and now["R1"]["community_tech_hours"] == 2.0 and now["R1"]["region"] == "N"
    assert by_key(store.rows(before=1))["R1"]["community_tech_hours"] == 1.0
    store.compact()
    assert by_key(store.rows()) == now
    store.upsert(event("R7", 5.0, 9), 3, ["event_time"], medians, DAY)
    wanted = spark.createDataFrame([("R7",)], "request_code string")
    assert by_key(store.rows(wanted))["R7"]["community_tech_hours"] == 5.0


def test_stream_equals_applying_files_in_order_and_restarts_cleanly(spark, tmp_path):
    store = RequestStore(spark, str(tmp_path / "store"), buckets=4)
    store.create(base_rows(spark))
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    schema = "request_code string, region string, community_tech_hours double, event_time timestamp"

    def drop(name, *events):
        (inbox / name).write_text("\n".join(json.dumps(e) for e in events))

    def at(minute):
        return datetime(2001, 8, 2, 10, minute).isoformat()

    def run():
        query = start_scoring(
            read_events(spark, str(inbox), schema, files_per_batch=1), store,
            lambda rows, day: rows.select("request_code", F.col("community_tech_hours").alias("proba")),
            str(tmp_path / "scores"), str(tmp_path / "checkpoint"), DAY,
        )
        query.awaitTermination()

    drop("1.json", {"request_code": "R1", "community_tech_hours": 5.0, "event_time": at(2)},
         {"request_code": "R1", "community_tech_hours": 4.0, "region": "W", "event_time": at(1)})
    drop("2.json", {"request_code": "R5", "region": "N", "event_time": at(3)})
    run()
    run()  # nothing new
    drop("3.json", {"request_code": "R5", "community_tech_hours": 1.0, "event_time": at(4)})
    run()
    now = by_key(store.rows())
    assert now["R1"]["community_tech_hours"] == 5.0 and now["R1"]["region"] == "W"
    assert now["R5"]["community_tech_hours"] == 1.0 and now["R5"]["region"] == "N"
    scores = spark.read.parquet(str(tmp_path / "scores")).collect()
    # The default of R5 is fixed when its stream starts: the median of region N then.
    assert sorted((r["request_code"], r["proba"]) for r in scores) == [("R1", 5.0), ("R5", 1.0), ("R5", 15.0)]
    assert EVENT_ORDER[0] == "event_time"


def hours_event(spark, code, region, at):
    return spark.createDataFrame([(code, region, at)], "request_code string, region string, event_time int")


def test_repeated_batch_is_the_same_after_a_restart(spark, tmp_path):
    """Defaults come from the base version a batch starts from, not from what later batches wrote."""
    path = str(tmp_path / "store")
    store = RequestStore(spark, path, buckets=4)
    store.create(base_rows(spark))
    first = by_key(store.upsert(hours_event(spark, "R9", "N", 1), 0, ["event_time"], store.default_medians(before=0), DAY))
    event = spark.createDataFrame([("R8", "N", 99.0, 2)], "request_code string, region string, community_tech_hours double, event_time int")
    store.upsert(event, 1, ["event_time"], store.default_medians(before=1), DAY)
    store.compact()
    again = RequestStore(spark, path, buckets=4)
    repeated = by_key(again.upsert(hours_event(spark, "R9", "N", 1), 0, ["event_time"], again.default_medians(before=0), DAY))
    assert repeated == first and first["R9"]["community_tech_hours"] == 15.0
    later = by_key(again.upsert(hours_event(spark, "R7", "N", 3), 2, ["event_time"], again.default_medians(before=2), DAY))
    assert later["R7"]["community_tech_hours"] == 17.5  # the new base holds 10, 20, 15 and 99


def test_unfinished_batches_are_not_read(spark, tmp_path):
    store = RequestStore(spark, str(tmp_path / "store"), buckets=4)
    store.create(base_rows(spark))
    event = spark.createDataFrame([("R1", 1.0, 1)], "request_code string, community_tech_hours double, event_time int")
    store.upsert(event, 0, ["event_time"], store.default_medians(before=0), DAY)
    (tmp_path / "store" / "changes" / "batch_id=0" / "_SUCCESS").unlink()
    assert by_key(store.rows())["R1"]["community_tech_hours"] == 10.0
    store.compact()
    assert by_key(store.rows())["R1"]["community_tech_hours"] == 10.0


def test_malformed_lines_are_kept_apart_and_staged_files_removed(spark, tmp_path):
    store = RequestStore(spark, str(tmp_path / "store"), buckets=4)
    store.create(base_rows(spark))
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "1.json").write_text('{"request_code": "R1", "community_tech_hours": 5.0}\n{"request_code": broken\n{"region": "N"}\n')
    days = []

    def score(rows, day):
        days.append(day)
        return rows.select("request_code")

    staged = Path(staging_root(spark).removeprefix("file:")) / "staged"
    before = set(staged.iterdir())
    events = read_events(spark, str(inbox), "request_code string, region string, community_tech_hours double")
    start_scoring(events, store, score, str(tmp_path / "scores"), str(tmp_path / "checkpoint"), DAY, compact_every=1).awaitTermination()
    assert [r.request_code for r in spark.read.parquet(str(tmp_path / "scores")).collect()] == ["R1"] and days == [DAY]
    refused = sorted(r.line for r in spark.read.parquet(str(tmp_path / "scores_refused")).collect())
    assert len(refused) == 2 and "broken" in refused[0] + refused[1] and '"region":"N"' in refused[0] + refused[1]
    assert set(staged.iterdir()) == before
    assert (tmp_path / "store" / "base" / "through_batch=0" / "_SUCCESS").exists()
    assert by_key(store.rows())["R1"]["community_tech_hours"] == 5.0
