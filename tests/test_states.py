"""Profiles merged from states equal those over the trips, before and after a
period is reloaded, emptied or moved; distinct counts are exact without Expand."""

from pyspark.sql import functions as F

from tripledger.config import Scope
from tripledger.operators import profile as P
from tripledger.operators import states as ST
from tripledger.operators.checks import symmetric_difference
from tripledger.plans import medallion as MD
from tripledger.plans import registry as R
from tripledger.session import unique_name
from tripledger.sinks import tables as W
from tests.conftest import SF_SMALL

SCOPE = Scope("1996-01", "1996-05")


def same(a, b):
    return symmetric_difference(a, b.select(*a.columns)).first()[0] == 0


def profiles_agree(bronze, b_states, silver, s_states):
    assert same(ST.period_volume(b_states), P.period_volume(bronze))
    assert same(ST.out_of_month(b_states), P.out_of_month(bronze))
    assert same(ST.panorama(b_states), P.panorama(bronze))
    assert same(ST.month_sources(b_states).withColumn(
        "arquivos_de_origem", F.array_join("arquivos_de_origem", ",")),
        P.month_sources(bronze).withColumn(
            "arquivos_de_origem", F.array_join("arquivos_de_origem", ",")))
    assert same(ST.scope_check(s_states), P.scope_check(silver))


def _load(spark, tables, rows, periods):
    W.replace_partitions(spark, rows, tables.bronze, "_ref_period", periods,
                         F.date_format("tpep_pickup_datetime", "yyyy-MM"))


def test_states_equal_the_profiles_through_reloads(spark):
    t = MD.Tables.prefixed(unique_name("st"))
    W.ensure_namespaces(spark, t.databases())
    given = R.stored(spark, R.bronze(spark, SF_SMALL, with_source=True).where(
        F.col("_ref_period").between("1995-12", "1996-06")), "few-periods")
    periods = [r[0] for r in given.select("_ref_period").distinct().collect()]
    _load(spark, t, given, periods)
    MD.build_silver(spark, SCOPE, t)
    MD.build_profiles(spark, t)

    def check():
        profiles_agree(spark.table(t.bronze), spark.table(t.bronze_states),
                       spark.table(t.silver), spark.table(t.silver_states))

    check()
    before = {r["_ref_period"]: r["rows"] for r in spark.table(t.bronze_states).groupBy(
        "_ref_period").agg(F.sum("rows").alias("rows")).collect()}
    one = given.where("_ref_period = '1996-02'")
    for rows in (one.where("l_orderkey % 2 = 0").withColumn("_source_file", F.lit("again")),
                 one.where("tpep_pickup_datetime IS NULL"), one.limit(0)):
        _load(spark, t, rows, ["1996-02"])
        months = MD.refresh_silver(spark, ["1996-02"], SCOPE, t)["meses"]
        MD.refresh_profiles(spark, ["1996-02"], months, t)
        check()
    after = {r["_ref_period"]: r["rows"] for r in spark.table(t.bronze_states).groupBy(
        "_ref_period").agg(F.sum("rows").alias("rows")).collect()}
    assert "1996-02" in before and "1996-02" not in after
    assert {k: v for k, v in before.items() if k != "1996-02"} == after


def test_a_refresh_reads_only_the_partitions_of_the_reloaded_period(spark):
    t = MD.Tables.prefixed(unique_name("st"))
    W.ensure_namespaces(spark, t.databases())
    given = R.stored(spark, R.bronze(spark, SF_SMALL, with_source=True).where(
        F.col("_ref_period").between("1996-01", "1996-03")), "three-periods")
    _load(spark, t, given, ["1996-01", "1996-02", "1996-03"])
    rows = ST.bronze_states(MD._pruned_bronze(spark, {"1996-02"}, t))
    p = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in p and "_ref_period" in p.split("PartitionFilters: [")[1][:400]
    assert [r[0] for r in rows.select("_ref_period").distinct().collect()] == ["1996-02"]


def _states(spark, months):
    rows = [(f"p{i % 3}" if i else None, "f", m, 1, None, None, None) for i, m in enumerate(months)]
    return spark.createDataFrame(
        rows, "_ref_period string, _source_file string, _month string, rows long, "
              "first_ingested timestamp, first_pickup timestamp_ntz, last_pickup timestamp_ntz")


def test_month_bits_are_exact_for_any_year(spark):
    """Months beyond one bitmap of 32,768 get bits of another; NULL is no month."""
    months = ["0001-01", "0001-12", "2730-08", "2730-09", "5461-04", "9999-12", "1996-05",
              "1996-05", None]
    got = ST.distinct_months(_states(spark, months)).first()["months"]
    assert got == len(set(months) - {None})
    row = ST.panorama(_states(spark, months)).first()
    assert (row["registros"], row["competencias"], row["meses_distintos"]) == (9, 3, 7)


def test_panorama_of_no_states_is_one_row_of_zeros(spark):
    row = ST.panorama(_states(spark, ["1996-01"]).limit(0)).first()
    assert (row["registros"], row["competencias"], row["meses_distintos"]) == (0, 0, 0)


def test_no_distinct_count_expands(spark):
    b = ST.bronze_states(R.bronze(spark, SF_SMALL, with_source=True))
    s = ST.silver_states(R.silver(spark, SF_SMALL))
    for df in (ST.period_volume(b), ST.panorama(b), ST.scope_check(s)):
        p = df._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in p and "distinct" not in p.lower()
