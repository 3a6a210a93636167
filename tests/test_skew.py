"""A hot join key: one order key holding a third of the line items.

The trips join is a sort-merge join with AQE skew handling on, so the
partition of a hot key is split over several tasks (the matching ``orders``
rows are replicated to each) instead of landing in one.  The thresholds are
lowered to test scale; the result must equal the plain join's.
"""

from pyspark.sql import functions as F

from tripledger.session import EXECUTION_CONF


def test_hot_order_key_is_split_and_join_is_exact(spark):
    assert EXECUTION_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
    n = 60_000
    li = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("l_orderkey"),
        (F.col("id") * 13 % 1000).alias("l_partkey"),
    )
    od = spark.range(n).select(F.col("id").alias("o_orderkey"),
                               (F.col("id") % 50).alias("o_custkey"))
    joined = li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey)
    agg = joined.agg(F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("s"),
                     F.sum("o_custkey").alias("c"))

    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = agg.collect()[0]
        final = agg._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final, final

    # Brute force: every line item matches exactly one order (key 7 for the
    # hot third).
    ids = range(n)
    keys_of = [7 if i % 3 == 0 else i for i in ids]
    assert got.n == n
    assert got.s == sum(i * 13 % 1000 for i in ids)
    assert got.c == sum(k % 50 for k in keys_of)
