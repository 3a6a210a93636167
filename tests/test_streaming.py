"""Incremental load: a landing zone that grows and gets a republished month,
processed by the file stream in two scheduled runs."""

import datetime as dt

from tripledger.config import Scope
from tripledger.plans import medallion as MD
from tripledger.session import unique_name
from tripledger.streaming import incremental as S

SCHEMA = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
          "passenger_count int, total_amount double")


def _month(spark, root, period, rows):
    data = [(v, p, p + dt.timedelta(minutes=m), n, a) for v, p, m, n, a in rows]
    y, mth = period.split("-")
    path = f"{root}/yellow_tripdata/ref_year={y}/ref_month={mth}"
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def test_incremental_runs(spark, tmp_path):
    root = str(tmp_path / "landing")
    scope = Scope("2023-01", "2023-03")
    t = MD.Tables.prefixed(unique_name("s"))
    ck = str(tmp_path / "ck")
    _month(spark, root, "2023-01", [(1, dt.datetime(2023, 1, 3, 9), 10, 1, 10.0),
                                    (2, dt.datetime(2022, 12, 31, 23), 5, 1, 9.0)])
    _month(spark, root, "2023-02", [(1, dt.datetime(2023, 2, 3, 9), 10, 2, 20.0),
                                    (1, dt.datetime(2023, 3, 1, 1), 10, 2, 21.0)])
    q = S.start(spark, root, scope, "2023-03", t, checkpoint=ck)
    q.awaitTermination(300)
    assert q.exception() is None
    by_month = {r.pickup_year_month: r.corridas for r in spark.table(t.monthly).collect()}
    assert by_month == {"2023-01": 1, "2023-02": 1, "2023-03": 1}

    # March arrives, February is republished without its March trip.
    _month(spark, root, "2023-03", [(2, dt.datetime(2023, 3, 9, 9), 10, 3, 30.0)])
    _month(spark, root, "2023-02", [(1, dt.datetime(2023, 2, 3, 9), 10, 2, 20.0)])
    q = S.start(spark, root, scope, "2023-03", t, checkpoint=ck)
    q.awaitTermination(300)
    assert q.exception() is None
    by_month = {r.pickup_year_month: r.corridas for r in spark.table(t.monthly).collect()}
    assert by_month == {"2023-01": 1, "2023-02": 1, "2023-03": 1}
    c = MD.conservation_tables(spark, t).collect()[0]
    assert (c.bronze, c.silver, c.quarentena, c.diferenca) == (4, 3, 1, 0)


def test_default_checkpoint_is_stable_per_tables_under_the_work_root(spark):
    from tripledger.session import work_root

    a, b = MD.Tables.prefixed(unique_name("s")), MD.Tables.prefixed(unique_name("s"))
    assert S.default_checkpoint(spark, a) == S.default_checkpoint(spark, a)
    assert S.default_checkpoint(spark, a) != S.default_checkpoint(spark, b)
    assert S.default_checkpoint(spark, a).startswith(work_root(spark) + "/")
