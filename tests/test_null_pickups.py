"""Trips without a pickup are valid and reach every table; a refresh equals a rebuild."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripledger.config import Scope
from tripledger.plans import medallion as MD
from tripledger.plans import registry as R
from tripledger.session import unique_name
from tripledger.sinks import tables as W

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def with_nulls(spark, tmp_path_factory):
    """The driver tables with NULL order dates, part keys and amounts here and there."""
    root = str(tmp_path_factory.mktemp("nulls"))
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate"))
                      ).write.parquet(f"{root}/orders.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    lines.withColumns({
        "l_partkey": F.when(F.col("l_orderkey") % 70 != 1, F.col("l_partkey")),
        "l_extendedprice": F.when(F.col("l_orderkey") % 30 != 2, F.col("l_extendedprice")),
    }).write.parquet(f"{root}/lineitem.parquet")
    return root


def test_silver_and_quarantine_hold_every_trip(spark, with_nulls):
    whole = R.classified(spark, with_nulls)
    valid = R.silver(spark, with_nulls)
    assert valid.filter(F.col("tpep_pickup_datetime").isNull()).count() > 0
    assert valid.count() == whole.filter("motivo_descarte IS NULL").count()
    assert R.QUERIES["conservation"](spark, with_nulls).first()["diferenca"] == 0


@pytest.mark.parametrize("column", ["tpep_pickup_datetime", "tpep_dropoff_datetime",
                                    "total_amount", "VendorID"])
def test_the_adapter_itself_has_missing_values(spark, column):
    """So the registered queries, and their oracles, meet NULL rows too."""
    from tripledger.sources import testdata as TD

    missing = TD.trips(spark, "/root/testdata/sf0.01").filter(F.col(column).isNull())
    assert missing.count() > 0
    in_focus = missing if column == "tpep_pickup_datetime" else missing.filter(
        F.date_format("tpep_pickup_datetime", "yyyy-MM") == TD.TEST_FOCUS_PERIOD)
    assert in_focus.count() > 0


def test_landing_keeps_trips_without_a_period(spark, with_nulls):
    from tripledger.sources import testdata as TD

    root = f"{with_nulls}/landing"
    paths = TD.write_trip_landing(spark, with_nulls, root)
    assert sum(spark.read.parquet(p).count() for p in paths.values()) == \
        TD.trips(spark, with_nulls).count()
    assert "0000-00" in paths


def _month(spark, path, rows):
    spark.createDataFrame(
        [(v, p, None if p is None else p + dt.timedelta(minutes=m), n, a) for v, p, m, n, a in rows],
        "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count int, total_amount double").write.mode("overwrite").parquet(path)
    return path


def test_refresh_equals_rebuild_with_null_pickups_and_an_emptied_month(spark, tmp_path):
    day = dt.datetime(2023, 1, 5, 10)
    scope = Scope("2023-01", "2023-05")
    t = MD.Tables.prefixed(unique_name("n"))

    def state():
        return {n: sorted(map(str, spark.table(x).select(
            "VendorID", "tpep_pickup_datetime", "total_amount").collect()))
            for n, x in (("bronze", t.bronze), ("silver", t.silver), ("quarantine", t.quarantine))}

    paths = {
        "2023-01": _month(spark, str(tmp_path / "a"), [(1, day, 20, 1, 10.0), (1, None, 0, 1, 11.0)]),
        "2023-02": _month(spark, str(tmp_path / "b"), [(2, day + dt.timedelta(days=31), 20, 1, 5.0)])}
    MD.load_bronze_all(spark, paths, t)
    MD.build_silver(spark, scope, t)
    # January comes again without its NULL pickup, February empty, then January with two.
    for january in ([(1, day, 20, 1, 10.0)],
                    [(1, day, 0, 1, 10.0), (1, None, 0, 2, 7.0), (2, None, 0, 2, 8.0)]):
        _month(spark, paths["2023-01"], january)
        _month(spark, paths["2023-02"], [])
        MD.load_bronze_all(spark, paths, t)
        MD.refresh_silver(spark, sorted(paths), scope, t)
        refreshed = state()
        assert len(refreshed["bronze"]) == len(january)
        assert MD.conservation_tables(spark, t).first()["diferenca"] == 0
        MD.build_silver(spark, scope, t)
        assert state() == refreshed


def test_a_null_partition_is_emptied(spark):
    t = f"{unique_name('w')}.t"
    W.ensure_namespaces(spark, (t.split(".")[0],))
    schema = "k int, p string"
    W.replace_partitions(spark, spark.createDataFrame([(1, None), (2, "x")], schema), t, "p", [None, "x"])
    W.replace_partitions(spark, spark.createDataFrame([], schema), t, "p", [None])
    assert [(r.k, r.p) for r in spark.table(t).collect()] == [(2, "x")]
