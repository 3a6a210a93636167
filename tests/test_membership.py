"""The membership filter loses no member and stays bounded; month queries shuffle
only the lines of their orders; two-phase duplicates equal the plain count."""

import re

import pytest
from pyspark.sql import functions as F

from tripledger.config import Scope
from tripledger.operators import profile as P
from tripledger.operators.membership import members, possible_members
from tripledger.plans import registry as R
from tripledger.sources import testdata as TD
from tests.conftest import SF_SMALL

KEYS = ["a", "b", "c"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_member_is_lost_and_repeated_rows_stay(spark):
    rows = spark.range(20_000).withColumn("id", F.col("id") % 10_000)
    wanted = spark.range(0, 10_000, 7)
    got = possible_members(rows, ["id"], members(wanted, ["id"]))
    assert got.columns == ["id"]
    counts = {r["id"]: r["count"] for r in got.groupBy("id").count().collect()}
    assert all(counts.get(i) == 2 for i in range(0, 10_000, 7))
    assert len(counts) < 1600  # 1,429 members; chance adds next to none at 2^26 bits


def test_a_saturated_filter_is_bounded_and_passes_everything(spark):
    found = members(spark.range(5_000), ["id"], bits=8)
    assert found.count() <= 4  # 2^8 bits in words of 64
    assert possible_members(spark.range(100), ["id"], found, bits=8).count() == 100


def test_an_empty_set_passes_nothing_and_nulls_meet_nulls(spark):
    empty = members(spark.range(0), ["id"])
    assert possible_members(spark.range(10), ["id"], empty).count() == 0
    nulls = spark.createDataFrame([(None,), (1,)], "id long")
    assert possible_members(nulls, ["id"], members(nulls, ["id"])).count() == 2


def test_month_query_shuffles_only_lines_of_its_orders(spark):
    """Above the scan of lineitem and below its exchange stands the filter."""
    month = Scope("1996-05", "1996-05")
    lines = plan(TD.trips(spark, SF_SMALL, pickup_scope=month)).split("\n")
    scan = next(i for i, x in enumerate(lines) if "lineitem.parquet" in x)
    exchange = max(i for i, x in enumerate(lines[:scan]) if "Exchange hashpartitioning(l_orderkey" in x)
    assert any("BroadcastHashJoin" in x and "LeftSemi" in x for x in lines[exchange:scan]), lines
    # And it does drop them: what passes is about what the month's orders hold.
    od = TD.table(spark, SF_SMALL, "orders").where("o_orderdate >= '1996-05-01'").where(
        "o_orderdate < '1996-06-01'")
    li = TD.table(spark, SF_SMALL, "lineitem")
    exact = li.join(od, li.l_orderkey == od.o_orderkey, "left_semi").count()
    passed = possible_members(li, ["l_orderkey"], members(od, ["o_orderkey"])).count()
    assert 0 < exact <= passed <= exact + 5 < li.count() / 10


def _rows(spark):
    nan, zero = float("nan"), 0.0
    rows = [(1, "x", 1.5)] * 3 + [(1, "x", 2.5), (None, "x", zero), (None, "x", -zero),
                                  (None, None, nan), (None, None, nan), (2, None, None),
                                  (None, None, None), (None, None, None)]
    rows += [(i, "one", float(i)) for i in range(10, 60)]
    return spark.createDataFrame(rows, "a int, b string, c double")


@pytest.mark.parametrize("digest", [None, "a % 2", "CAST(0 AS BIGINT)"])
def test_two_phase_duplicates_equal_the_plain_count(spark, digest):
    """With real digests, with planted collisions, and with one digest for all."""
    df = _rows(spark)
    got = P.duplicate_summary_by_digest(df, KEYS, None if digest is None else F.expr(digest))
    assert got.collect() == P.duplicate_summary(df, KEYS).collect()
    assert tuple(got.first()) == (4, 9, 5, 3)


def test_two_phase_duplicates_of_no_rows_and_of_no_repeats(spark):
    for df in (_rows(spark).limit(0), _rows(spark).where("b = 'one'")):
        got = P.duplicate_summary_by_digest(df, KEYS).collect()
        assert got == P.duplicate_summary(df, KEYS).collect()


def test_two_phase_duplicates_shuffle_whole_keys_after_the_filter(spark):
    df = R.bronze(spark, SF_SMALL).select(*P.duplicate_keys())
    lines = plan(P.duplicate_summary_by_digest(R.stored(spark, df, "keys"))).split("\n")
    wide = next(i for i, x in enumerate(lines)
                if re.search(r"Exchange hashpartitioning\(VendorID.*total_amount", x))
    assert any("LeftSemi" in x for x in lines[wide:])
    below = next(i for i, x in enumerate(lines[wide:], wide) if "LeftSemi" in x)
    assert any("Exchange hashpartitioning(_digest" in x for x in lines[below:])
