"""Writes: single-partition overwrite keeps the others, empty input empties
the partition, stray rows fail the write; rebuilds; the medallion round trip
with conservation; incremental silver refresh."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripledger.config import Scope
from tripledger.plans import medallion as MD
from tripledger.session import unique_name
from tripledger.sinks import tables as W

SCHEMA = "k int, v string, p string"


def test_overwrite_partition_is_idempotent_and_isolated(spark):
    t = f"{unique_name('w')}.t"
    W.ensure_namespaces(spark, (t.split(".")[0],))
    W.overwrite_partition(spark, spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], SCHEMA),
                          t, "p", "x")
    W.overwrite_partition(spark, spark.createDataFrame([(3, "c", "y")], SCHEMA), t, "p", "y")
    n = W.overwrite_partition(spark, spark.createDataFrame([(4, "d", "x")], SCHEMA), t, "p", "x")
    assert n == 1
    got = sorted((r.k, r.p) for r in spark.table(t).collect())
    assert got == [(3, "y"), (4, "x")]
    # rerun: same content
    W.overwrite_partition(spark, spark.createDataFrame([(4, "d", "x")], SCHEMA), t, "p", "x")
    assert spark.table(t).count() == 2
    # empty input empties only that partition
    W.overwrite_partition(spark, spark.createDataFrame([], SCHEMA), t, "p", "x")
    assert sorted(r.p for r in spark.table(t).collect()) == ["y"]


def test_row_outside_partition_fails(spark):
    t = f"{unique_name('w')}.t"
    W.ensure_namespaces(spark, (t.split(".")[0],))
    W.overwrite_partition(spark, spark.createDataFrame([(1, "a", "x")], SCHEMA), t, "p", "x")
    with pytest.raises(Exception, match="outside partition"):
        W.overwrite_partition(spark, spark.createDataFrame([(2, "b", "z")], SCHEMA), t, "p", "x")
    assert [r.k for r in spark.table(t).collect()] == [1]


def test_dynamic_overwrite_replaces_only_present_partitions(spark):
    t = f"{unique_name('w')}.t"
    W.ensure_namespaces(spark, (t.split(".")[0],))
    W.overwrite_partitions(spark, spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "y")], SCHEMA), t, "p")
    W.overwrite_partitions(spark, spark.createDataFrame([(3, "c", "y")], SCHEMA), t, "p")
    assert sorted((r.k, r.p) for r in spark.table(t).collect()) == [(1, "x"), (3, "y")]


def test_rebuild_and_comment_and_history(spark):
    t = f"{unique_name('w')}.t"
    W.ensure_namespaces(spark, (t.split(".")[0],))
    assert W.rebuild(spark, spark.createDataFrame([(1, "a", "x")], SCHEMA), t) == 1
    assert W.rebuild(spark, spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SCHEMA), t) == 2
    W.comment_table(spark, t, "it's a table")
    assert spark.table(t).count() == 2
    assert [r.rows for r in W.load_history(spark, t).collect()] == [2, 1]


def _landing(spark, tmp_path):
    """Three small month files; the February file carries a March trip."""
    rows = {
        "2023-01": [(1, dt.datetime(2023, 1, 5, 10), 20, 1, 10.0),
                    (2, dt.datetime(2022, 12, 31, 23), 10, 2, 11.0),   # out of scope
                    (1, dt.datetime(2023, 1, 6, 11), 0, None, 12.0)],   # zero duration
        "2023-02": [(2, dt.datetime(2023, 2, 5, 9), 15, 3, -5.0),
                    (6, dt.datetime(2023, 3, 1, 0, 5), 30, 1, 30.0)],   # March trip
        "2023-03": [(1, dt.datetime(2023, 3, 9, 8), 25, 0, 40.0)],
    }
    paths = {}
    for period, rs in rows.items():
        data = [(v, p, p + dt.timedelta(minutes=m), n, a) for v, p, m, n, a in rs]
        path = str(tmp_path / f"yellow_tripdata_{period}.parquet")
        spark.createDataFrame(data, "VendorID int, tpep_pickup_datetime timestamp_ntz, "
                              "tpep_dropoff_datetime timestamp_ntz, passenger_count int, "
                              "total_amount double").write.parquet(path)
        paths[period] = path
    return paths


def test_medallion_roundtrip_and_incremental_refresh(spark, tmp_path):
    scope = Scope("2023-01", "2023-03")
    t = MD.Tables.prefixed(unique_name("m"))
    paths = _landing(spark, tmp_path)
    results = MD.build_bronze(spark, paths, t)
    MD.assert_complete(results)
    assert [r.rows for r in results] == [3, 2, 1]
    counts = MD.build_silver(spark, scope, t)
    assert counts == {"validos": 4, "descartados": 2}
    c = MD.conservation_tables(spark, t).collect()[0]
    assert (c.bronze, c.silver, c.quarentena, c.diferenca) == (6, 4, 2, 0)
    gold = MD.build_gold(spark, "2023-03", t)
    assert gold == {"monthly": 3, "hourly": 2}
    march = spark.table(t.monthly).filter("pickup_year_month = '2023-03'").collect()[0]
    assert march.corridas == 2  # one trip from the February file

    # February file republished without its March trip: only Feb and Mar move.
    feb = str(tmp_path / "feb_v2.parquet")
    spark.read.parquet(paths["2023-02"]).filter(F.col("VendorID") == 2).write.parquet(feb)
    MD.load_bronze_period(spark, feb, "2023-02", t)
    assert MD.affected_months(spark, ["2023-02"], t) == ["2023-02", "2023-03"]
    MD.refresh_silver(spark, ["2023-02"], scope, t)
    by_month = {r.pickup_year_month: r["count"] for r in
                spark.table(t.silver).groupBy("pickup_year_month").count().collect()}
    assert by_month == {"2023-01": 1, "2023-02": 1, "2023-03": 1}
    c = MD.conservation_tables(spark, t).collect()[0]
    assert c.diferenca == 0 and c.bronze == 5


def test_failed_period_is_isolated(spark, tmp_path):
    t = MD.Tables.prefixed(unique_name("f"))
    paths = _landing(spark, tmp_path)
    paths["2023-04"] = str(tmp_path / "missing.parquet")
    results = MD.build_bronze(spark, paths, t)
    status = {r.period: r.status for r in results}
    assert status == {"2023-01": "loaded", "2023-02": "loaded", "2023-03": "loaded",
                      "2023-04": "failed"}
    with pytest.raises(RuntimeError, match="2023-04"):
        MD.assert_complete(results)


def test_describe_and_namespaces(spark):
    db = unique_name("ns")
    W.ensure_namespaces(spark, (db,))
    W.ensure_namespaces(spark, (db,))  # idempotent
    assert db in {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    t = f"{db}.t"
    W.rebuild(spark, spark.createDataFrame([(1, "a", "x")], SCHEMA), t, "p")
    cols = [r.col_name for r in W.describe(spark, t).collect()]
    assert cols[:3] == ["k", "v", "p"]
    assert W.table_exists(spark, t) and not W.table_exists(spark, f"{db}.missing")


def test_not_a_plain_name_is_refused(spark):
    with pytest.raises(ValueError):
        W.rebuild(spark, spark.createDataFrame([(1, "a", "x")], SCHEMA), "x; DROP TABLE y")
