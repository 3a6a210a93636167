"""Exact quantiles against brute force, with one group holding a third of
the rows, NULLs, ties and a group with no values."""

import math
import random

from tripledger.operators.quantiles import approx_quantiles, exact_quantiles

PROBS = [("p01", 0.01), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p9999", 0.9999)]


def brute(values, q):
    vs = sorted(v for v in values if v is not None)
    if not vs:
        return None
    return vs[max(1, math.ceil(q * len(vs))) - 1]


def test_exact_quantiles_match_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{i % 17}"
        v = None if i % 29 == 0 else round(rnd.choice([rnd.uniform(-50, 500), 12.5]), 2)
        rows.append((g, v))
    rows += [("empty", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, "v", PROBS, ["g"]).collect()}
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    for g, vs in groups.items():
        for name, q in PROBS:
            assert getattr(got[g], name) == brute(vs, q), (g, name)


def test_global_quantiles_and_approx_agree_on_small_data(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 1001)], "v double")
    ex = exact_quantiles(df, "v", PROBS).collect()[0]
    ap = approx_quantiles(df, "v", PROBS).collect()[0]
    for name, q in PROBS:
        assert ex[name] == brute(list(range(1, 1001)), q) == ap[name]


EXTREMES = [float("-inf"), -1.7e308, -5000.0, -1.0, -1e-300, -5e-324, 0.0, -0.0, 5e-324,
            1e-300, 0.01, 0.99, 1.0, 1.0000001, 2.0, 12.5, 1024.0, 1e15, 1.7e308,
            float("inf"), float("nan")]


def _spark_order_key(x):
    # Spark orders NaN after every other double, and -0.0 equal to 0.0.
    return (1, 0.0) if math.isnan(x) else (0, x + 0.0)


def test_value_bucket_preserves_order(spark):
    from pyspark.sql import functions as F

    from tripledger.operators.quantiles import value_bucket

    rnd = random.Random(11)
    values = EXTREMES + [rnd.uniform(-1e6, 1e6) for _ in range(500)] + \
        [rnd.choice([-1, 1]) * 2.0 ** rnd.uniform(-1070, 1020) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", value_bucket(F.col("v")).alias("b")).collect()
    rows.sort(key=lambda r: _spark_order_key(r.v))
    buckets = [r.b for r in rows]
    assert buckets == sorted(buckets)
    assert all(b is not None for b in buckets)


def test_exact_quantiles_with_extreme_values_and_a_hot_value(spark):
    rnd = random.Random(3)
    values = EXTREMES * 3 + [12.5] * 2000 + [rnd.uniform(-100, 100) for _ in range(1500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = PROBS + [("p0", 0.0), ("p100", 1.0), ("p999", 0.999)]
    got = exact_quantiles(df, "v", probs).collect()[0]
    ordered = sorted(values, key=_spark_order_key)
    for name, q in probs:
        want = ordered[max(1, math.ceil(q * len(ordered))) - 1]
        g = got[name]
        assert (math.isnan(g) and math.isnan(want)) or g == want, (name, g, want)


def test_exact_quantiles_on_integer_durations(spark):
    values = [None] * 5 + list(range(-600, 90000, 7)) + [0] * 300
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = exact_quantiles(df, "v", PROBS).collect()[0]
    for name, q in PROBS:
        assert got[name] == brute(values, q), name


def test_a_hot_bucket_is_split(spark):
    """200,000 distinct values of one bucket: the last step holds few of them."""
    from pyspark.sql import functions as F

    from tripledger.operators import quantiles as Q

    n = 200_000
    df = spark.range(n).select((F.lit(1000.0) + F.col("id") * 1e-9).alias("v"))
    counts = Q.value_histogram(df, "v").withColumn("_b", Q.value_bucket(F.col("_v")))
    assert counts.select("_b").distinct().count() == 1
    ends = Q._bucket_of_ranks(counts, [], PROBS)
    for _ in range(Q.LEVELS):
        ends = Q._narrowed(counts, ends, [])
    left = Q._values_between(counts, ends, []).groupBy("_name").count().collect()
    assert {r["_name"] for r in left} == {name for name, _ in PROBS}
    assert max(r["count"] for r in left) <= 2
    got = Q.exact_quantiles(df, "v", PROBS).first()
    values = sorted(r.v for r in df.collect())
    assert [got[name] for name, _ in PROBS] == [brute(values, q) for _, q in PROBS]


def test_quantiles_of_decimals_and_of_nothing(spark):
    from decimal import Decimal

    values = [Decimal(k) / 100 for k in range(-500, 70000, 37)]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(12,2)")
    got = exact_quantiles(df, "v", PROBS).first()
    assert [got[name] for name, _ in PROBS] == [brute(values, q) for _, q in PROBS]
    assert list(exact_quantiles(df.where("false"), "v", PROBS).first()) == [None] * len(PROBS)
    assert exact_quantiles(df.where("false").withColumn("g", df.v), "v", PROBS, ["g"]).count() == 0
