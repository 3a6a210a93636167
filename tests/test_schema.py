"""Schema resolution, the required check and the drifting-source read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tripledger.config import CANONICAL_TYPES, REQUIRED_COLUMNS
from tripledger.sources.landing import read_landing, read_landing_grouped
from tripledger.sources.schema import SchemaMismatch, absent, fit, fit_or_refuse


def _schema(names, kind=None):
    return StructType([StructField(n, kind or StringType()) for n in names])


@pytest.mark.parametrize("available,wanted,expected", [
    (["airport_fee"], "airport_fee", "airport_fee"),
    (["Airport_fee"], "airport_fee", "Airport_fee"),
    (["VendorID"], "vendorid", "VendorID"),
    (["total_amount"], "trip_distance", None),
    ([], "VendorID", None),
])
def test_fit_matches_names_without_case(available, wanted, expected):
    served = fit(_schema(available), {wanted: "string"}).served_by[wanted]
    assert (served and served.name) == expected


def test_required_missing_raises_naming_column_and_period():
    cols = [c for c in REQUIRED_COLUMNS if c != "total_amount"]
    with pytest.raises(SchemaMismatch, match="2023-01.*total_amount"):
        fit_or_refuse(_schema(cols), "2023-01")


def test_required_exact_and_mixed_case_pass():
    fit_or_refuse(_schema(REQUIRED_COLUMNS), "2023-01")
    fit_or_refuse(_schema([c.upper() for c in REQUIRED_COLUMNS]), "2023-01")
    assert absent([c.lower() for c in REQUIRED_COLUMNS]) == []


def test_names_differing_only_in_case_are_refused():
    with pytest.raises(SchemaMismatch, match="Fee.*fee"):
        fit_or_refuse(_schema(["Fee", "fee"]), "2023-01", {"fee": "double"}, ())


def test_a_type_that_cannot_be_cast_is_refused():
    nested = _schema(["fee"], ArrayType(StringType()))
    with pytest.raises(SchemaMismatch, match="array<string>"):
        fit_or_refuse(nested, "2023-01", {"fee": "double"}, ())


@pytest.mark.parametrize("incomplete", ["a", "z"])
def test_one_incomplete_file_refuses_the_period(spark, tmp_path, incomplete):
    folder = tmp_path / "ref_year=2023" / "ref_month=05"
    _write(spark, str(folder / "m"), "int", "airport_fee")
    _write(spark, str(folder / incomplete), "int", "airport_fee", drop="total_amount")
    with pytest.raises(ValueError, match="total_amount"):
        read_landing(spark, str(folder), "2023-05")


def test_files_of_one_period_may_differ_in_optional_columns(spark, tmp_path):
    folder = tmp_path / "ref_year=2023" / "ref_month=06"
    _write(spark, str(folder / "a"), "int", "airport_fee")
    _write(spark, str(folder / "b"), "long", "Airport_fee", extra=True)
    _write(spark, str(folder / "c"), "int", "other_fee")
    read = read_landing(spark, str(folder), "2023-06")
    assert read.unexpected == ["brand_new_col", "other_fee"]
    assert sorted(str(r.airport_fee) for r in read.df.collect()) == ["1.75", "1.75", "None"]


def test_canonical_types_cover_required_and_keep_ntz():
    assert set(REQUIRED_COLUMNS) <= set(CANONICAL_TYPES)
    assert CANONICAL_TYPES["tpep_pickup_datetime"] == "timestamp_ntz"
    assert CANONICAL_TYPES["tpep_dropoff_datetime"] == "timestamp_ntz"


def _write(spark, path, id_type, fee_name, extra=False, drop=None):
    import datetime as dt

    rows = [(1, dt.datetime(2023, 1, 5, 10), dt.datetime(2023, 1, 5, 10, 20), 2, 12.5, 1.75)]
    df = spark.createDataFrame(
        rows, "VendorID int, tpep_pickup_datetime timestamp_ntz, "
              "tpep_dropoff_datetime timestamp_ntz, passenger_count int, total_amount double, "
              "fee double")
    df = df.select(F.col("VendorID").cast(id_type).alias("VendorID"), "tpep_pickup_datetime",
                   "tpep_dropoff_datetime",
                   F.col("passenger_count").cast(id_type).alias("passenger_count"),
                   "total_amount", F.col("fee").alias(fee_name))
    if extra:
        df = df.withColumn("brand_new_col", F.lit("x"))
    if drop:
        df = df.drop(drop)
    df.write.parquet(path)


def test_drifting_months_read_and_union(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    _write(spark, a, "int", "airport_fee")
    _write(spark, b, "long", "Airport_fee", extra=True)
    rb = read_landing(spark, b, "2023-02")
    assert rb.unexpected == ["brand_new_col"]
    assert "RatecodeID" in rb.missing_optional
    u = read_landing(spark, a, "2023-01").df.unionByName(rb.df)
    g = read_landing_grouped(spark, {"2023-01": a, "2023-02": b})
    for df in (u, g):
        assert dict(df.dtypes)["VendorID"] == "int"
        assert dict(df.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
        assert sorted(r._ref_period for r in df.collect()) == ["2023-01", "2023-02"]
        assert [r.airport_fee for r in df.collect()] == [1.75, 1.75]
        assert df.filter(F.col("_source_file").isNull()).count() == 0


def test_footers_are_read_by_tasks_and_once_per_schema_on_the_driver(spark, tmp_path, monkeypatch):
    from tripledger.sources import landing as L

    paths = {}
    for month in range(1, 8):
        paths[f"2023-{month:02d}"] = str(tmp_path / f"month {month}%")
        _write(spark, paths[f"2023-{month:02d}"], "long" if month % 2 else "int",
               "Airport_fee" if month % 2 else "airport_fee", extra=month == 7)
    read = []
    schema_of = L._footer_schema
    monkeypatch.setattr(L, "_footer_schema", lambda s, f: read.append(f) or schema_of(s, f))
    by_tasks = L.landed_files(spark, paths)
    assert len(read) == 3
    assert sorted({f.period for f in by_tasks}) == sorted(paths)
    assert [f.schema for f in by_tasks] == [spark.read.parquet(f.path).schema for f in by_tasks]
    # A store that tasks cannot open: the same answer, a footer at a time.
    monkeypatch.setattr(L, "TASK_STORES", ())
    assert L.landed_files(spark, paths) == by_tasks
    assert len(read) == 3 + len(by_tasks)
    df = read_landing_grouped(spark, paths)
    assert sorted(r._ref_period for r in df.collect()) == sorted(paths)


def test_paths_of_periods_must_be_apart(spark, tmp_path):
    _write(spark, str(tmp_path / "a"), "int", "airport_fee")
    for other in (str(tmp_path), str(tmp_path / "a")):
        with pytest.raises(ValueError, match="2023-01|lies in"):
            read_landing_grouped(spark, {"2023-01": str(tmp_path / "a"), "2023-02": other})
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError, match="2023-02"):
        read_landing_grouped(spark, {"2023-01": str(tmp_path / "a"),
                                     "2023-02": str(tmp_path / "none")})


def test_missing_required_column_fails_the_read(spark, tmp_path):
    p = str(tmp_path / "c")
    _write(spark, p, "int", "airport_fee", drop="total_amount")
    with pytest.raises(ValueError, match="total_amount"):
        read_landing(spark, p, "2023-03")


def test_overflowing_cast_fails_instead_of_nulling(spark, tmp_path):
    p = str(tmp_path / "d")
    spark.createDataFrame([(2**40,)], "VendorID long").select(
        "VendorID", F.lit(None).cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.lit(None).cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        F.lit(1).alias("passenger_count"), F.lit(1.0).alias("total_amount")).write.parquet(p)
    with pytest.raises(Exception):
        read_landing(spark, p, "2023-04").df.collect()


def test_declared_driver_schemas_equal_the_files(spark):
    """The fixed schemas the adapter reads with are what Spark infers from
    the driver's files, at every scale."""
    import pytest

    from pyspark.sql.types import StructType
    from tripledger.sources.testdata import TABLE_SCHEMAS

    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        for name, ddl in TABLE_SCHEMAS.items():
            inferred = spark.read.parquet(f"{sf}/{name}.parquet").schema
            declared = StructType.fromDDL(ddl)
            got = [(f.name, f.dataType) for f in inferred.fields]
            want = [(f.name, f.dataType) for f in declared.fields]
            if got != want:
                pytest.fail(f"{sf}/{name}: {got} != {want}")


def test_configure_leaves_execution_settings_alone():
    """Results-relevant settings are set; sizes and adaptive execution stay."""
    from tripledger.session import SEMANTIC_CONF, configure

    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf({"spark.sql.files.maxPartitionBytes": "16m"})

    configure(Session)
    assert Session.conf == {**SEMANTIC_CONF, "spark.sql.files.maxPartitionBytes": "16m"}


def test_period_of_files_in_period_folders_is_cut_not_searched(spark, tmp_path):
    from tripledger.sources.landing import period_from_path, read_landing_grouped

    cols = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
            "VendorID int, passenger_count int, total_amount double")
    at = dt.datetime(2023, 2, 3, 9)

    def land(path, amount):
        spark.createDataFrame([(at, at, 1, 1, amount)], cols).coalesce(1).write.parquet(path)

    paths = {f"2023-0{m}": f"{tmp_path}/a 50%/ref_year=2023/ref_month=0{m}" for m in (1, 2)}
    for m, (_, path) in enumerate(paths.items(), 1):
        land(path, float(m))
    grouped = read_landing_grouped(spark, paths)
    plan = grouped._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan, plan
    got = {(r._ref_period, r._ref_year, r._ref_month, r.total_amount) for r in grouped.collect()}
    assert got == {("2023-01", 2023, 1, 1.0), ("2023-02", 2023, 2, 2.0)}
    searched = spark.read.parquet(*paths.values()).select(
        period_from_path().alias("p"), "total_amount").collect()
    assert {(r.p, r.total_amount) for r in searched} == {(g[0], g[3]) for g in got}

    # Deeper, dated and repeated folders are told as before: by search.
    paths["2023-03"] = f"{tmp_path}/ref_year=2023/ref_month=03/deep"
    land(paths["2023-03"], 3.0)
    got = {(r._ref_period, r._ref_month, r.total_amount)
           for r in read_landing_grouped(spark, paths).collect()}
    assert got == {("2023-01", 1, 1.0), ("2023-02", 2, 2.0), ("2023-03", 3, 3.0)}
