"""Plan properties that matter at scale: pushed-down month bounds, column
pruning, partial aggregation, no Expand for distinct counts."""

from pyspark.sql import functions as F

from tripledger.functions.trips import in_month
from tripledger.operators import metrics as M
from tripledger.operators import profile as P
from tripledger.plans import registry as R
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_range_reaches_parquet_scan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet").filter(in_month("1996-05", "ts"))
    p = plan(df)
    assert "PushedFilters" in p and "GreaterThanOrEqual(ts" in p and "LessThan(ts" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(R.hourly_passengers(spark, SF_SMALL))
    li_schema = [line for line in p.split("\n") if "lineitem" in line and "ReadSchema" in line]
    assert li_schema, p
    assert "l_returnflag" not in li_schema[0] and "l_tax" not in li_schema[0]


def test_aggregates_are_partial_then_final(spark):
    p = plan(M.monthly_revenue(R.silver(spark, SF_SMALL)))
    assert "partial_" in p


def test_panorama_expands_only_aggregated_pairs(spark):
    """The distinct counts expand the (period, month) pairs, which are already
    aggregated from the trips, never the trips themselves."""
    p = plan(P.panorama(R.bronze(spark, SF_SMALL)))
    first_agg = p.index("HashAggregate(keys=[_ref_period")
    assert "Expand" not in p[first_agg:]


def test_profile_projection_prunes_unused_aggregates(spark):
    full = plan(P.global_profile(R.bronze(spark, SF_SMALL)))
    one = plan(P.completeness(R.bronze(spark, SF_SMALL)))
    assert "timestampdiff" in full.lower() and "timestampdiff" not in one.lower()


def test_exact_quantiles_never_window_over_raw_rows(spark):
    """Windows sort totals of buckets and cells, produced by aggregates."""
    p = plan(P.amount_distribution(R.bronze(spark, SF_SMALL)))
    window_at = p.index("Window [")
    assert "HashAggregate" in p[window_at:]
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_fact_join_is_sort_merge_never_broadcast(spark):
    p = plan(R.classified(spark, SF_SMALL))
    assert "SortMergeJoin" in p and "BroadcastExchange" not in p


def test_silver_pushes_the_implied_order_date_range_to_orders(spark):
    p = plan(R.hourly_passengers(spark, SF_SMALL))
    orders = [line for line in p.split("\n") if "orders.parquet" in line]
    assert orders and "GreaterThanOrEqual(o_orderdate" in orders[0] \
        and "LessThan(o_orderdate" in orders[0], orders


def test_restricted_silver_equals_full_silver(spark):
    """The implied order-date range drops no valid trip, for the scope and
    for a one-month range; silver over the full join is the reference."""
    from tripledger.config import Scope
    from tripledger.operators import quality as Q
    from tripledger.operators.checks import symmetric_difference

    full = Q.valid_rows(R.classified(spark, SF_SMALL))
    assert symmetric_difference(R.silver(spark, SF_SMALL), full).first()[0] == 0
    month = Scope("1996-03", "1996-03")
    in_month_rows = full.filter(F.col("pickup_year_month") == "1996-03")
    got = R.silver(spark, SF_SMALL, month).filter(F.col("pickup_year_month") == "1996-03")
    assert in_month_rows.count() > 0
    assert symmetric_difference(got, in_month_rows).first()[0] == 0


def test_exact_quantiles_read_the_histogram_of_chosen_buckets(spark):
    """Every level joins the counts with the buckets that hold a rank, and its
    windows run by bucket, cell and, in the last cell, value."""
    p = plan(P.amount_distribution(R.bronze(spark, SF_SMALL)))
    assert all(f"windowspecdefinition({key}" in p or f", {key}" in p
               for key in ("_b#", "_cell#", "_v#"))


def test_file_lineage_is_read_only_by_queries_that_use_it(spark):
    assert "_metadata" not in plan(R.panorama(spark, SF_SMALL))
    assert "row_index" not in plan(R.completeness(spark, SF_SMALL))
    assert "file_path" in plan(R.period_volume(spark, SF_SMALL))
