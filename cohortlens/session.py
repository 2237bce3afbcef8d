"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (the fixture timestamps are
# zone-less and the oracle compares them as such), AQE for runtime
# re-planning of joins / partition counts / skew, Arrow for pandas exchange.
_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "cohortlens",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to roughly input bytes / 128 MB (AQE coalesces
    downwards at run time, it never splits upwards).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may hand back a session built elsewhere: pin the
    # runtime-settable options that results depend on.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    A cluster names it in ``spark.checkpoint.dir``; that value is always
    used. Where it is unset, a folder set on the context is used, and only a
    local session (tests) gets a scratch folder: executors of a cluster
    could not see one, so there a missing folder is an error.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        current = sc._jsc.sc().getCheckpointDir()
        path = current.get() if current.isDefined() else None
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cohortlens-ckpt-",
                                dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def materialize(df):
    """Cut lineage: write ``df`` to the shared checkpoint folder (eager
    ``checkpoint``) and continue from the written copy. A lost executor
    then re-reads the files instead of recomputing the whole plan."""
    at = checkpoint_dir(df.sparkSession)
    if (kept := _kept.get()) is None:
        return df.checkpoint(eager=True)
    # Compressed by column: a checkpoint holds rows as they are in memory.
    path = f"{at.rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.append((out, path))
    return out


_kept: ContextVar[list | None] = ContextVar("kept", default=None)


def discard(df) -> None:
    """Remove the written copy behind ``df``, a result of ``materialize``
    that nothing reads any more."""
    path = next((p for out, p in _kept.get() or () if out is df), None)
    if path is None:
        at = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        path = at.get() if at.isDefined() else None
    if path is not None:
        sc = df.sparkSession.sparkContext
        place = sc._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark):
    """What is materialised inside is written compressed and removed at the
    end; nothing lazy may leave it. Spark keeps shuffle files until the driver's garbage is collected,
    which a driver with little to do puts off for long, so that is asked for."""
    token = _kept.set(made := [])
    try:
        yield
    finally:
        for df, _ in made:
            discard(df)
        _kept.reset(token)
        made.clear()
        gc.collect()
        spark.sparkContext._jvm.System.gc()


#: Rows that a partition of model input should hold, and the least that are
#: worth a task of their own.
_ROWS_MOST, _ROWS_LEAST = 1 << 18, 1 << 14


def wanted_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for rows that are passed over again and again: two tasks a
    core, if the rows last for that, and tasks of bounded size."""
    busy = max(2 * spark.sparkContext.defaultParallelism, -(-rows // _ROWS_MOST))
    return max(1, min(busy, rows // _ROWS_LEAST))


def spread(df):
    """``materialize``, dealt over enough partitions for all cores. A scan
    gives a small file to few tasks, and AQE merges small shuffles; a model
    fitted on their output would run on as few cores."""
    return dealt(materialize(df))


def dealt(df):
    """``df``, a result of ``materialize``, over enough partitions for all
    cores: itself, or a copy in its place."""
    wanted = wanted_partitions(df.sparkSession, df.count())
    if df.rdd.getNumPartitions() >= wanted:
        return df
    out = materialize(df.repartition(wanted))
    discard(df)
    return out


def fits_at_once(rows: int, most: int = 8) -> int:
    """Fits to submit together: many where one can't fill the cores, few
    where each keeps a copy of many rows."""
    return max(2, min(most, (1 << 22) // max(1, rows)))


_TARGET_PARTITION_BYTES = 128 * 1024 * 1024


_SIZED = "cohortlens.shuffle.sized"


def size_shuffle_partitions(spark, base_dir: str, tables=("events", "lineitem", "documents")) -> int | None:
    """Set ``spark.sql.shuffle.partitions`` from the input size when the
    session runs with Spark's default (200) or with a value that an earlier
    call set for another input: one partition per
    128 MB of the largest input table (Catalyst's size estimate, so any
    filesystem works), at least the cluster's default parallelism. AQE
    still coalesces small shuffles at run time. A value set explicitly by
    the cluster or user is left alone. Returns the value set, or None."""
    if spark.conf.get("spark.sql.shuffle.partitions") not in ("200", spark.conf.get(_SIZED, "200")):
        return None
    size = 0
    for t in tables:
        try:
            plan = spark.read.parquet(f"{base_dir.rstrip('/')}/{t}.parquet")._jdf.queryExecution()
            size = max(size, int(str(plan.optimizedPlan().stats().sizeInBytes())))
        except AnalysisException:  # the table is absent
            continue
    n = max(spark.sparkContext.defaultParallelism, -(-size // _TARGET_PARTITION_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set(_SIZED, str(n))
    return n
