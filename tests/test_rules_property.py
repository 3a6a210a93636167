"""Property test: the Spark classification agrees with a plain statement of
the rules on generated trips (NULLs, sub-second times, edges of the scope)."""

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripledger.config import REASON_BAD_DURATION, REASON_OUT_OF_SCOPE, Scope
from tripledger.operators.quality import classify

SCOPE = Scope("2023-01", "2023-05")
SCHEMA = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
          "passenger_count int, total_amount double, _ref_period string")

times = st.one_of(st.none(), st.datetimes(min_value=dt.datetime(2022, 12, 31, 23, 59, 58),
                                          max_value=dt.datetime(2023, 6, 1, 0, 0, 2)))
trip = st.tuples(
    st.one_of(st.none(), st.sampled_from([1, 2, 6, 7])),
    times,
    st.one_of(st.none(), st.integers(-3600, 200000)),
    st.one_of(st.none(), st.integers(0, 9)),
    st.one_of(st.none(), st.sampled_from([-5.0, 0.0, 0.01, 12.5, 2000.0])),
)


def expected(vendor, pickup, dropoff, passengers, amount):
    dur = None
    if pickup is not None and dropoff is not None:
        dur = calendar.timegm(dropoff.timetuple()) - calendar.timegm(pickup.timetuple())
    month = pickup.strftime("%Y-%m") if pickup is not None else None
    if month is not None and not (SCOPE.first <= month <= SCOPE.last):
        reason = REASON_OUT_OF_SCOPE
    elif dur is not None and dur <= 0:
        reason = REASON_BAD_DURATION
    else:
        reason = None
    return {
        "trip_duration_seconds": dur,
        "pickup_year_month": month,
        "flag_valor_nao_positivo": None if amount is None else amount <= 0,
        "flag_duracao_extrema": None if dur is None else dur > 86400,
        "flag_passageiros_ausente": passengers is None,
        "flag_passageiros_zero": None if passengers is None else passengers == 0,
        "flag_passageiros_implausivel": None if passengers is None else passengers > 6,
        "flag_vendor_fora_dicionario": None if vendor is None else vendor not in (1, 2),
        "motivo_descarte": reason,
    }


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trip, min_size=1, max_size=60))
def test_classify_matches_rules(spark, trips):
    rows = []
    for vendor, pickup, secs, passengers, amount in trips:
        dropoff = None if pickup is None or secs is None else pickup + dt.timedelta(seconds=secs)
        rows.append((vendor, pickup, dropoff, passengers, amount, "2023-01"))
    got = classify(spark.createDataFrame(rows, SCHEMA), SCOPE).collect()
    assert len(got) == len(rows)
    for r in got:  # classify keeps its input columns, so each row carries its inputs
        want = expected(r.VendorID, r.tpep_pickup_datetime, r.tpep_dropoff_datetime,
                        r.passenger_count, r.total_amount)
        for k, v in want.items():
            assert r[k] == v, (k, r, want)
