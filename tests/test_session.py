"""Shared-folder staging: written tables, reuse within an application, input signatures."""

from affinis.session import ensure_checkpoint_dir, input_signature, scratch_path, stage, stage_once

from conftest import SF


def test_stage_writes_under_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    df = stage(spark.range(10), "t")
    def path(u):
        return u.split(":", 1)[1].lstrip("/") if u.startswith("file:") else u.lstrip("/")
    assert df.inputFiles() and all(path(f).startswith(path(base)) for f in df.inputFiles())
    assert df.count() == 10
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_stage_once_reuses_per_key(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    a = stage_once(spark, "reuse", ("k1",), build)
    b = stage_once(spark, "reuse", ("k1",), build)
    c = stage_once(spark, "reuse", ("k2",), build)
    assert len(calls) == 2
    assert a.inputFiles() == b.inputFiles() and a.inputFiles() != c.inputFiles()


def test_input_signature_tracks_files(spark):
    s1 = input_signature(spark, [f"{SF}/part.parquet", f"{SF}/no_such.parquet"])
    assert s1[0][1] > 0 and s1[1][1] == -1
    assert s1 == input_signature(spark, [f"{SF}/part.parquet", f"{SF}/no_such.parquet"])


def test_input_signature_sees_files_deeper_down(spark, tmp_path):
    d = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(d)
    before = input_signature(spark, [d])
    spark.range(99).selectExpr("id").write.mode("append").parquet(d + "/part=1")
    assert input_signature(spark, [d]) != before


def test_staged_tables_are_written_in_zstd(spark):
    t = stage(spark.range(1000), "numbers")
    assert t.count() == 1000 and all(f.endswith(".zstd.parquet") for f in t.inputFiles())
