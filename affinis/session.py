"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import time
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "affinis",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE, partition coalescing and skew-join handling switched on.

    With a ``master`` (local runs, tests, bench) the shuffle partition count
    is the number of local cores.  Without one (a cluster submit) the
    partition count, memory and checkpoint folder come from the cluster's
    configuration; AQE coalesces shuffle partitions to its advisory size.
    """
    b = SparkSession.builder.appName(app)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if master:
        b = b.master(master)
        cpus = int(os.environ.get("BENCH_CPUS", "8"))
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
        conf["spark.driver.memory"] = "16g"
    elif shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The session's setting always wins.  Without one, a local master gets a
    folder under /tmp; on a cluster that would be each machine's own disk, so
    there a missing setting is an error.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = "/tmp/affinis-checkpoints"
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder; removed when the application ends."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/affinis-scratch/{spark.sparkContext.applicationId}"
    if base not in _SCRATCH:
        _SCRATCH.add(base)
        # the JVM deletes what its file systems have marked when it shuts down, also after a failed job
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(base)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{base}/{uuid.uuid4().hex}/{name}"


_STAGED: dict[tuple, str] = {}

#: Seconds spent on writing staged tables in this process, for the benchmark.
staging_seconds = 0.0


def forget_staged() -> None:
    """Let every table be written anew, as in a fresh application."""
    _STAGED.clear()


def input_signature(spark: SparkSession, paths: list[str]) -> tuple:
    """(path, total bytes, latest modification time) of each input, read through Hadoop's FileSystem."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    sig = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if not fs.exists(hp):
            sig.append((p, -1, -1))
            continue
        size, mtime = 0, 0
        files = fs.listFiles(hp, True)          # recursive: partitioned tables keep their files deeper down
        while files.hasNext():
            st = files.next()
            size += st.getLen()
            mtime = max(mtime, st.getModificationTime())
        sig.append((p, size, mtime))
    return tuple(sig)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp)


def _write(df, name: str, **options) -> str:
    path = scratch_path(df.sparkSession, name)
    t = time.time()
    df.write.mode("errorifexists").option("compression", "zstd").options(**options).parquet(path)
    global staging_seconds
    staging_seconds += time.time() - t
    return path


def stage(df, name: str, **options):
    """Write ``df`` as Parquet to a fresh folder in the shared checkpoint directory and read it back.

    Used at pipeline boundaries: it cuts lineage (a lost executor recomputes
    from the written table, not from the raw inputs), turns a table that
    feeds several branches into one scan per branch instead of one
    recomputation per branch, and keeps column pruning and filter pushdown
    for its readers.  ``options`` go to the Parquet writer.
    """
    return df.sparkSession.read.parquet(_write(df, name, **options))


def stage_once(spark: SparkSession, name: str, key: tuple, build):
    """``stage(build(), name)``, reused within this Spark application for the same key.

    ``key`` must identify the inputs (see ``input_signature``) and every
    parameter of ``build``; a changed input file gives a new key and a fresh
    table.
    """
    k = (spark.sparkContext.applicationId, ensure_checkpoint_dir(spark), name) + tuple(key)
    path = _STAGED.get(k)
    if path is None or not _exists(spark, path):
        path = _write(build(), name)
        _STAGED[k] = path
    return spark.read.parquet(path)
