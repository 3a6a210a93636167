"""Classification rules on literal trips: discard reasons, flags, derived
columns and conservation (the silver rule fixture, plus NULL/NaN/sub-second
cases the rules must also handle)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripledger.config import REASON_BAD_DURATION, REASON_OUT_OF_SCOPE, Scope
from tripledger.operators.quality import classify, discarded_rows, split, valid_rows

SCOPE = Scope("2023-01", "2023-05")
SCHEMA = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
          "passenger_count int, total_amount double, _ref_period string")
BASE_PICKUP = dt.datetime(2023, 3, 15, 14, 30, 0)


def trip(pickup=BASE_PICKUP, duration=dt.timedelta(minutes=20), dropoff=None,
         passengers=1, amount=25.0, vendor=1, ref="2023-03"):
    if dropoff is None and pickup is not None and duration is not None:
        dropoff = pickup + duration
    return (vendor, pickup, dropoff, passengers, amount, ref)


def run(spark, *rows):
    return classify(spark.createDataFrame(list(rows), SCHEMA), SCOPE).collect()


def one(spark, **kw):
    return run(spark, trip(**kw))[0]


def test_valid_trip_has_no_reason(spark):
    assert one(spark).motivo_descarte is None


@pytest.mark.parametrize("pickup", [dt.datetime(2008, 12, 31, 23, 1, 42),
                                    dt.datetime(2001, 1, 1, 0, 6, 49),
                                    dt.datetime(2023, 9, 5, 18, 20, 48)])
def test_out_of_scope_is_discarded(spark, pickup):
    assert one(spark, pickup=pickup).motivo_descarte == REASON_OUT_OF_SCOPE


@pytest.mark.parametrize("minutes", [-30, -1, 0])
def test_nonpositive_duration_is_discarded(spark, minutes):
    r = one(spark, duration=dt.timedelta(minutes=minutes))
    assert r.motivo_descarte == REASON_BAD_DURATION


def test_first_reason_wins(spark):
    r = one(spark, pickup=dt.datetime(2008, 12, 31, 23, 0, 0), duration=dt.timedelta(minutes=-5))
    assert r.motivo_descarte == REASON_OUT_OF_SCOPE


def test_month_comes_from_trip_not_file(spark):
    r = one(spark, pickup=dt.datetime(2023, 2, 1, 0, 56, 53), ref="2023-01")
    assert r.motivo_descarte is None and r.pickup_year_month == "2023-02"
    r = one(spark, pickup=dt.datetime(2023, 4, 10, 8, 0, 0), ref="2023-03")
    assert r.pickup_year_month == "2023-04"


@pytest.mark.parametrize("amount", [-982.95, -10.0, 0.0])
def test_nonpositive_amount_is_flagged_not_dropped(spark, amount):
    r = one(spark, amount=amount)
    assert r.motivo_descarte is None and r.flag_valor_nao_positivo is True


def test_extreme_duration_flagged(spark):
    r = one(spark, duration=dt.timedelta(hours=48))
    assert r.motivo_descarte is None and r.flag_duracao_extrema is True
    r = one(spark, duration=dt.timedelta(seconds=86400))
    assert r.flag_duracao_extrema is False  # strictly greater than a day


def test_missing_passengers_flagged_and_kept_null(spark):
    r = one(spark, passengers=None)
    assert r.flag_passageiros_ausente is True and r.passenger_count is None
    assert r.motivo_descarte is None


def test_zero_passengers(spark):
    r = one(spark, passengers=0, amount=51.65)
    assert r.flag_passageiros_zero is True and r.motivo_descarte is None


@pytest.mark.parametrize("n,flag", [(4, False), (6, False), (7, True), (9, True)])
def test_implausible_passengers(spark, n, flag):
    assert one(spark, passengers=n).flag_passageiros_implausivel is flag


@pytest.mark.parametrize("vendor,flag", [(1, False), (2, False), (6, True)])
def test_vendor_dictionary(spark, vendor, flag):
    assert one(spark, vendor=vendor).flag_vendor_fora_dicionario is flag


def test_derived_hour_and_duration(spark):
    r = one(spark, pickup=dt.datetime(2023, 5, 20, 2, 15, 0))
    assert r.pickup_hour == 2
    assert one(spark).trip_duration_seconds == 1200
    assert r.pickup_day_of_week == 7  # 2023-05-20 is a Saturday; 1 = Sunday


def test_conservation_on_small_batch(spark):
    rows = [trip(), trip(pickup=dt.datetime(2008, 12, 31, 23, 0, 0)),
            trip(duration=dt.timedelta(0)), trip(amount=-50.0), trip(passengers=None)]
    df = classify(spark.createDataFrame(rows, SCHEMA), SCOPE)
    valid, discarded = split(df)
    assert valid.count() == 3 and discarded.count() == 2
    assert "motivo_descarte" not in valid.columns


def test_null_pickup_falls_through_as_valid(spark):
    r = one(spark, pickup=None, dropoff=dt.datetime(2023, 3, 1, 0, 0))
    assert r.motivo_descarte is None and r.pickup_year_month is None


def test_null_amount_flag_is_null(spark):
    r = one(spark, amount=None)
    assert r.flag_valor_nao_positivo is None


def test_nan_amount_counts_as_positive(spark):
    r = one(spark, amount=float("nan"))
    assert r.flag_valor_nao_positivo is False


def test_subsecond_durations_truncate_each_side(spark):
    p = dt.datetime(2023, 3, 1, 10, 0, 0, 900000)
    r = one(spark, pickup=p, dropoff=dt.datetime(2023, 3, 1, 10, 0, 1, 100000))
    assert r.trip_duration_seconds == 1 and r.motivo_descarte is None


def test_scope_edges(spark):
    assert one(spark, pickup=dt.datetime(2023, 1, 1, 0, 0, 0)).motivo_descarte is None
    assert one(spark, pickup=dt.datetime(2023, 5, 31, 23, 59, 59),
               duration=dt.timedelta(seconds=1)).motivo_descarte is None
    assert one(spark, pickup=dt.datetime(2022, 12, 31, 23, 59, 59)).motivo_descarte == \
        REASON_OUT_OF_SCOPE


def test_month_format_ignores_session_zone(spark):
    """Wall-clock NTZ values keep their month and hour whatever the zone."""
    from tripledger.session import configure

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        configure(spark)  # pins UTC again
        r = one(spark, pickup=dt.datetime(2023, 3, 12, 2, 30, 0))
        assert r.pickup_hour == 2 and r.pickup_year_month == "2023-03"
    finally:
        configure(spark)


def test_valid_and_discarded_are_complementary(spark):
    rows = [trip(pickup=dt.datetime(2023, m, 2), duration=dt.timedelta(seconds=s))
            for m in (1, 3, 6) for s in (-5, 0, 5)]
    df = classify(spark.createDataFrame(rows, SCHEMA), SCOPE)
    assert valid_rows(df).count() + discarded_rows(df).count() == len(rows)
    assert df.filter(F.col("motivo_descarte").isNull()).count() == 2
