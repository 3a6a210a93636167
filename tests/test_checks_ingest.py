"""Checks (symmetric difference with a seeded mismatch, scope check) and the
landing decisions (unchanged file skipped, resized or rewritten file loaded)."""

import hashlib
import random

from tripledger.config import Scope
from tripledger.operators import checks as C
from tripledger.operators import ingest as I
from tripledger.sources.landing import MANIFEST_SCHEMA, landing_fingerprint, read_manifest


def test_symmetric_difference_counts_both_directions(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "w"), (None, "z")], "k int, v string")
    assert C.symmetric_difference(a, b).collect()[0][0] == 2
    assert C.symmetric_difference(a, a).collect()[0][0] == 0
    assert a.exceptAll(b).count() + b.exceptAll(a).count() == 2


def test_scope_exact(spark):
    df = spark.createDataFrame([("2023-01",), ("2023-02",), ("2023-07",)],
                               "pickup_year_month string")
    got = {(r.pickup_year_month, r.problema) for r in
           C.scope_exact(df, Scope("2023-01", "2023-03")).collect()}
    assert got == {("2023-03", "ausente"), ("2023-07", "fora_do_escopo")}


def test_unknown_size_keeps_a_recorded_file(spark):
    landed = spark.createDataFrame(
        [("2023-01", "a", None, None), ("2023-02", "b", None, None)],
        "period string, landing_path string, bytes long, sha256 string")
    recorded = spark.createDataFrame(
        [("2023-01", "downloaded", 10, "h", None, "a", None, "2024-01-01")], MANIFEST_SCHEMA)
    got = {r.period: (r.status, r.reason) for r in I.ingest_decision(landed, recorded).collect()}
    assert got == {"2023-01": ("skip", "size_unknown"), "2023-02": ("load", "new")}
    forced = I.ingest_decision(landed, recorded, force=True).collect()
    assert {(r.status, r.reason) for r in forced} == {("load", "forced")}


def test_ingest_decisions(spark, tmp_path):
    for name, size in (("a", 10), ("b", 20), ("c", 30)):
        (tmp_path / f"yellow_tripdata_2023-0{ord(name) - 96}.parquet").write_bytes(b"x" * size)
    fp = landing_fingerprint(spark, str(tmp_path))
    first = I.ingest_decision(fp, spark.createDataFrame([], MANIFEST_SCHEMA))
    assert {r.status for r in first.collect()} == {"load"}
    # the manifest is persisted before the files change, as a run appends it
    I.manifest_records(first).write.json(str(tmp_path / "_manifest"))
    manifest = read_manifest(spark, str(tmp_path / "_manifest"))
    # 2023-02 republished with another size, 2023-03 with the same size but new bytes
    (tmp_path / "yellow_tripdata_2023-02.parquet").write_bytes(b"x" * 21)
    (tmp_path / "yellow_tripdata_2023-03.parquet").write_bytes(b"y" * 30)
    second = {r.period: (r.status, r.reason) for r in
              I.ingest_decision(landing_fingerprint(spark, str(tmp_path)), manifest).collect()}
    assert second == {"2023-01": ("skip", "unchanged"), "2023-02": ("load", "size_changed"),
                      "2023-03": ("load", "content_changed")}
    forced = I.ingest_decision(landing_fingerprint(spark, str(tmp_path)), manifest, force=True)
    assert {r.status for r in forced.collect()} == {"load"}
    summary = {r.status: r.arquivos for r in
               I.ingest_summary(I.ingest_decision(landing_fingerprint(spark, str(tmp_path)),
                                                  manifest)).collect()}
    assert summary == {"load": 2, "skip": 1}


def test_fingerprint_of_files_too_long_for_one_row(spark, tmp_path):
    rng = random.Random(4)
    contents = {"2023-01": rng.randbytes(50_000), "2023-02": rng.randbytes(20_000) + b"\n",
                "2023-03": b"\n" * 3000, "2023-04": b"\r\n\xff" * 1000, "2023-05": b"short",
                "2023-07": b"z" * 4000}
    for period, content in contents.items():
        (tmp_path / f"trips_{period}.parquet").write_bytes(content)
    settings = {"spark.sql.sources.binaryFile.maxLength": "1000",
                "spark.sql.files.maxPartitionBytes": "7000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = {r.period: (r.bytes, r.sha256) for r in
               landing_fingerprint(spark, str(tmp_path)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {p: (len(c), hashlib.sha256(c).hexdigest()) for p, c in contents.items()}


def test_fingerprint_of_a_long_file_holds_blocks_only(spark, tmp_path, monkeypatch):
    from tripledger.sources import landing as L

    monkeypatch.setattr(L, "WHOLE_FILE", 1000)
    content = random.Random(5).randbytes(30_000)
    (tmp_path / "trips 50%_2023-01.parquet").write_bytes(content)
    (tmp_path / "trips_2023-02.parquet").write_bytes(b"short")
    want = {("2023-01", 30_000, hashlib.sha256(content).hexdigest()),
            ("2023-02", 5, hashlib.sha256(b"short").hexdigest())}
    monkeypatch.setattr(L, "HASH_BLOCK", 4096, raising=False)
    streamed = landing_fingerprint(spark, str(tmp_path))
    plan = streamed._jdf.queryExecution().executedPlan().toString()
    # A sort or an exchange would bring a file's bytes together in one task.
    assert "Sort" not in plan and "Exchange" not in plan and "content" not in plan, plan
    assert {(r.period, r.bytes, r.sha256) for r in streamed.collect()} == want
    # Stores that tasks cannot open: by Spark's readers alone.
    monkeypatch.setattr(L, "TASK_STORES", ())
    by_rows = landing_fingerprint(spark, str(tmp_path)).collect()
    assert {(r.period, r.bytes, r.sha256) for r in by_rows} == want


def test_required_present_and_volume_band(spark):
    df = spark.createDataFrame([(1, 2)], "vendorid int, PASSENGER_COUNT int")
    assert C.required_present(df) == ["total_amount", "tpep_dropoff_datetime",
                                      "tpep_pickup_datetime"]
    vol = spark.createDataFrame([("2023-01", 3_000_000, 1), ("2023-02", 10, 2)],
                                "_ref_period string, registros long, arquivos_origem long")
    got = {r._ref_period: (r.um_arquivo, r.volume_na_faixa)
           for r in C.volume_band(vol, 2_900_000, 3_500_000).collect()}
    assert got == {"2023-01": (True, True), "2023-02": (False, False)}


def test_conservation_counts(spark):
    a = spark.range(10)
    c = C.conservation(a, a.filter("id < 7"), a.filter("id >= 7")).collect()[0]
    assert (c.bronze, c.silver, c.quarentena, c.diferenca) == (10, 7, 3, 0)
    c = C.conservation(a, a.filter("id < 7"), a.filter("id > 7")).collect()[0]
    assert c.diferenca == -1
