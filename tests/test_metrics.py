"""Gold monthly revenue read off the (month, amount) histogram against the
direct aggregates, on rows with NULL and NaN amounts, -0.0, a NULL month and
a hot value; the exact median against brute force."""

import math
import random

from pyspark.sql import functions as F

from tripledger.operators import metrics as M

SCHEMA = "pickup_year_month string, total_amount double"


def _rows():
    rnd = random.Random(5)
    rows = []
    for i in range(4000):
        m = None if i % 97 == 0 else f"2023-0{1 + i % 4}"
        a = rnd.choice([None, float("nan"), -0.0, 0.0, -12.5, 19.99, 19.99, 19.99]
                       + [round(rnd.uniform(-30, 300), 2)] * 6)
        rows.append((m, a))
    rows += [("2023-05", None), ("2023-05", None)]  # a month with no amount
    return rows


def _silver(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    return df.withColumn("flag_valor_nao_positivo", F.col("total_amount") <= 0)


def test_histogram_path_equals_direct_aggregates(spark):
    s = _silver(spark)
    exact = {r.pickup_year_month: r for r in M.monthly_revenue(s).collect()}
    direct = {r.pickup_year_month: r for r in M.monthly_revenue(s, median="approx").collect()}
    assert exact.keys() == direct.keys() and None in exact
    for m, d in direct.items():
        e = exact[m]
        for col in ("corridas", "corridas_faturadas", "lancamentos_nao_positivos"):
            assert e[col] == d[col], (m, col)
        for col in ("ticket_medio_bruto", "ticket_medio_sem_nao_positivos",
                    "faturamento_bruto", "faturamento_sem_nao_positivos"):
            a, b = e[col], d[col]
            assert (a is None and b is None) or (math.isnan(a) and math.isnan(b)) \
                or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9), (m, col, a, b)


def test_exact_median_is_the_lower_middle_value(spark):
    got = {r.pickup_year_month: r.mediana_total_amount
           for r in M.monthly_revenue(_silver(spark)).collect()}
    groups = {}
    for m, a in _rows():
        groups.setdefault(m, []).append(a)
    for m, vals in groups.items():
        vs = sorted((v for v in vals if v is not None),
                    key=lambda x: (1, 0.0) if math.isnan(x) else (0, x + 0.0))
        want = vs[max(1, math.ceil(0.5 * len(vs))) - 1] if vs else None
        g = got[m]
        assert (g is None and want is None) or g == want \
            or (math.isnan(g) and math.isnan(want)), (m, g, want)


def test_median_method_is_checked(spark):
    import pytest

    with pytest.raises(ValueError):
        M.monthly_revenue(_silver(spark), median="mean")


def test_histogram_profiles_equal_direct_aggregates(spark):
    """A15 and A17 read counts, mean and extremes off their histograms; they
    must equal the direct aggregates, with NULL durations, NaN amounts and a
    hot value, and the quantiles must equal brute force."""
    import datetime as dt

    from tripledger.operators import profile as P

    rnd = random.Random(9)
    base = dt.datetime(2023, 3, 1)
    rows = []
    for i in range(3000):
        p = None if i % 50 == 0 else base + dt.timedelta(seconds=rnd.randint(0, 86400 * 20))
        d = None if p is None or i % 77 == 0 else p + dt.timedelta(
            seconds=rnd.choice([0, -30, 600, 600, 600, 90000, rnd.randint(1, 5000)]))
        a = rnd.choice([None, float("nan"), 0.0, -5.5, 19.99, 19.99] + [round(rnd.uniform(-20, 400), 2)] * 5)
        rows.append((p, d, a))
    df = spark.createDataFrame(
        [(1, 1) + r for r in rows],
        "VendorID int, passenger_count int, tpep_pickup_datetime timestamp_ntz, "
        "tpep_dropoff_datetime timestamp_ntz, total_amount double")
    g = P.global_profile(df).first()
    dur = P.duration_profile(df).first()
    for c in ("total", "sem_duracao", "duracao_negativa", "duracao_zero", "acima_de_24h",
              "media_minutos", "maximo_horas"):
        assert dur[c] == g[c], c
    secs = sorted(int((d - p).total_seconds()) for p, d, _ in rows if p and d)
    assert dur.mediana_minutos == round(secs[math.ceil(len(secs) / 2) - 1] / 60, 1)

    amt = P.amount_distribution(df).first()
    for c in ("minimo", "maximo", "media"):
        a, b = amt[c], g[c]
        assert (math.isnan(a) and math.isnan(b)) or a == b, (c, a, b)
    vals = sorted((a for _, _, a in rows if a is not None),
                  key=lambda x: (1, 0.0) if math.isnan(x) else (0, x))
    for name, q in P.AMOUNT_QUANTILES:
        want = vals[max(1, math.ceil(q * len(vals))) - 1]
        got = amt[name]
        assert (math.isnan(got) and math.isnan(want)) or got == round(want, 2), name
