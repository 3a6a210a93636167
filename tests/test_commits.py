"""All-or-nothing commits, the period-month index, and gold kept by states."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tripledger.config import Scope
from tripledger.plans import medallion as MD
from tripledger.session import unique_name
from tripledger.sinks import tables as W

SCHEMA = "k int, p string"


@pytest.fixture
def table(spark):
    name = f"{unique_name('c')}.t"
    W.ensure_namespaces(spark, (name.split(".")[0],))
    return name


def _rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_a_failure_before_publishing_changes_nothing(spark, table, monkeypatch):
    W.replace_partitions(spark, spark.createDataFrame([(1, "x"), (2, "y")], SCHEMA),
                         table, "p", ["x", "y"])
    before = _rows(spark, table), W.load_history(spark, table).count(), W.manifest(spark, table)

    def state():
        return _rows(spark, table), W.load_history(spark, table).count(), W.manifest(spark, table)

    new = spark.createDataFrame([(3, "x")], SCHEMA)
    for step in ("_staged_counts", "_publish"):
        with monkeypatch.context() as patch:
            patch.setattr(W, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError(step)))
            with pytest.raises(RuntimeError):  # x would be written, y emptied
                W.replace_partitions(spark, new, table, "p", ["x", "y"])
            with pytest.raises(RuntimeError):
                W.rebuild(spark, new.withColumn("more", F.lit(1)), table, "p")
        assert state() == before
    with pytest.raises(Exception, match="by zero|DIVIDE"):  # fails while writing
        W.rebuild(spark, new.withColumn("k", F.col("k") / (F.col("k") - 3)), table, "p")
    assert state() == before
    W.replace_partitions(spark, new, table, "p", ["x", "y"])
    assert _rows(spark, table) == [(3, "x")]
    history = [(r.partition_value, r.rows) for r in W.load_history(spark, table).collect()]
    assert history == [("x", 1), ("y", 0), ("x", 1), ("y", 1)]


def test_a_rebuild_may_read_its_own_table(spark, table):
    W.rebuild(spark, spark.createDataFrame([(1, "x"), (2, "y")], SCHEMA), table, "p", "a comment")
    W.rebuild(spark, spark.table(table).withColumn("k", F.col("k") * 10).withColumn("n", F.lit(1)),
              table, "p")
    assert sorted(spark.table(table).columns) == ["k", "n", "p"]
    assert sorted(r.k for r in spark.table(table).collect()) == [10, 20]
    assert W.manifest(spark, table).comment == "a comment"
    W.rebuild(spark, spark.table(table).where("false"), table, "p")
    assert _rows(spark, table) == []


def test_partition_filters_prune_and_vacuum_removes_what_was_replaced(spark, table):
    for k in range(3):
        W.replace_partitions(spark, spark.createDataFrame([(k, "x"), (k, None)], SCHEMA),
                             table, "p", ["x", None])
    plan = spark.table(table).where("p = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_load.*p#\d+ = x", plan), plan
    assert W.vacuum(spark, table) == 4
    assert spark.table(table).where("k = 2").count() == 2 and spark.table(table).count() == 2
    assert W.vacuum(spark, table) == 0
    W.comment_table(spark, table, "it's new")
    assert W.manifest(spark, table).comment == "it's new" and spark.table(table).count() == 2


def test_columns_must_stay_and_foreign_tables_are_refused(spark, table):
    W.overwrite_partitions(spark, spark.createDataFrame([(1, "x")], SCHEMA), table, "p")
    with pytest.raises(ValueError, match="differ"):
        W.overwrite_partitions(spark, spark.createDataFrame([("x",)], "p string").withColumn(
            "other", F.lit(1)), table, "p")
    spark.createDataFrame([(1, "x")], SCHEMA).write.option(
        "path", W.table_location(spark, f"{table}2")).saveAsTable(f"{table}2")
    with pytest.raises(ValueError, match="not written by commits"):
        W.manifest(spark, f"{table}2")


def test_namespaces_are_listed(spark, table):
    db = table.split(".")[0]
    assert W.list_namespaces(spark, db) == [db]
    assert db in W.list_namespaces(spark)
    assert W.list_namespaces(spark, "no_such_*") == []


TRIP = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count int, total_amount double")


def _land(spark, path, rows):
    spark.createDataFrame(
        [(v, p, None if p is None else p + dt.timedelta(minutes=m), n, a)
         for v, p, m, n, a in rows], TRIP).write.mode("overwrite").parquet(path)
    return path


def _scans(df):
    """(table folder, partition filters) of every scan of a plan."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    return re.findall(r"FileScan parquet (\S+?)\[.*?PartitionFilters: \[(.*?)\], PushedFilters",
                      plan)


def test_refresh_reads_and_writes_only_what_changed(spark, tmp_path, monkeypatch):
    scope, t = Scope("2023-01", "2023-06"), MD.Tables.prefixed(unique_name("g"))
    base = dt.datetime(2023, 1, 5, 10)
    days = {f"2023-0{m}": base + dt.timedelta(days=30 * (m - 1)) for m in range(1, 7)}
    paths = {p: _land(spark, str(tmp_path / p), [
        (1, d, 20, 1, 10.0 + i), (2, d, 0, 2, 5.0), (1, d, 30, None, -3.0), (2, d, 9, 0, 10.0 + i),
        (1, d + dt.timedelta(days=29), 12, 3, 1.5), (1, None, 0, 1, None)])
        for i, (p, d) in enumerate(days.items())}
    MD.load_bronze_all(spark, paths, t)
    MD.build_silver(spark, scope, t)
    MD.build_gold(spark, "2023-03", t)

    def gold():
        return {name: sorted(map(str, spark.table(name).select(
            sorted(spark.table(name).columns)).collect())) for name in (t.monthly, t.hourly)}

    index = {(p, m): n for p, m, n in W.manifest(spark, t.bronze).marks}
    assert index[("2023-02", "2023-02")] == 4 and index[("2023-02", None)] == 1
    assert sum(index.values()) == 36

    # February loses everything; March comes with a trip of May.
    _land(spark, paths["2023-02"], [])
    _land(spark, paths["2023-03"], [(1, days["2023-05"], 7, 4, 99.0), (1, days["2023-03"], 7, 4, 9.0)])
    commits, staged = [], W._stage

    def watch(spark_, df, base_, load, part):
        commits.append((base_.split("__")[0], _scans(df)))
        staged(spark_, df, base_, load, part)

    monkeypatch.setattr(W, "_stage", watch)
    periods = ["2023-02", "2023-03"]
    MD.load_bronze_all(spark, {p: paths[p] for p in periods}, t)
    months = MD.affected_months(spark, periods, t, scope)
    assert months == ["2023-02", "2023-03", "2023-04", "2023-05", None]
    commits.clear()
    done = MD.refresh_silver(spark, periods, scope, t)
    assert done["meses"] == months
    before = W.manifest(spark, t.monthly).live
    MD.refresh_gold(spark, periods, months, scope, "2023-03", t)
    after = W.manifest(spark, t.monthly).live
    assert [x for x in before if x[0] in ("2023-01", "2023-06")] == \
        [x for x in after if x[0] in ("2023-01", "2023-06")]
    # Every scan names its partitions; silver itself is not read.
    assert [name for name, _ in commits] == [
        t.classified, t.monthly_states, t.hourly_states, t.monthly, t.hourly]
    for name, scans in commits:
        assert scans and all("_ref_period" in filters for _, filters in scans), (name, scans)

    refreshed = gold()
    assert MD.conservation_tables(spark, t).first()["diferenca"] == 0
    MD.build_silver(spark, scope, t)
    MD.build_gold(spark, "2023-03", t)
    assert gold() == refreshed


def test_silver_and_quarantine_come_from_one_scan_of_bronze(spark, tmp_path, monkeypatch):
    scope, t = Scope("2023-01", "2023-06"), MD.Tables.prefixed(unique_name("o"))
    day = dt.datetime(2023, 1, 5, 10)
    path = _land(spark, str(tmp_path / "a"), [(1, day, 20, 1, 10.0), (2, day, 0, 2, 5.0)])
    MD.load_bronze_all(spark, {"2023-01": path}, t)
    jobs, staged = [], W._stage
    monkeypatch.setattr(W, "_stage", lambda s, df, *a: (jobs.append(df), staged(s, df, *a)))
    assert MD.build_silver(spark, scope, t) == {"validos": 1, "descartados": 1}
    (job,) = jobs
    executed = job._jdf.queryExecution().executedPlan().toString()
    assert executed.count("FileScan") == 1
    plan = spark.table(t.silver).where("pickup_year_month = '2023-01'")._jdf.queryExecution() \
        .executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_slot", plan), plan
    assert "motivo_descarte" not in spark.table(t.silver).columns
    # A failed rebuild leaves both layers as they were.
    monkeypatch.setattr(W, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
    with pytest.raises(RuntimeError):
        MD.build_silver(spark, scope, t)
    assert spark.table(t.silver).count() == 1 and spark.table(t.quarantine).count() == 1
