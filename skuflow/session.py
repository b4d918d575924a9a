"""Session helpers: local sessions for tests/bench, and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


_LOCAL_FALLBACK: dict[int, str] = {}
_STAGES: list[str] = []             # stage folders that no pipeline owns


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``. When it is unset, a local
    session (tests) gets a fresh temporary folder; on a cluster, where each
    executor has its own disk, that is an error. Works without a SparkContext
    handle too (e.g. a Spark Connect session)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no JVM context handle on this session type
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        if configured:
            sc.setCheckpointDir(configured)
            return configured
    if configured:
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master or ""):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = id(spark)
    if key not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="skuflow-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(_LOCAL_FALLBACK[key])
    return _LOCAL_FALLBACK[key]


def materialize(df, name: str = "stage", written: list[str] | None = None, by: tuple[str, ...] = ()):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: one job, lineage cut, survives the loss of any executor. The folder is
    added to ``written``, for `delete_stages`, or to those that `release_stages`
    deletes. ``by``: columns to partition the
    files by (few values), so that readers of one value skip the others."""
    import uuid
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/skuflow-stages/{uuid.uuid4().hex[:12]}-{name}"
    (_STAGES if written is None else written).append(path)
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    return out.select(*df.columns) if by else out


def materialize_each(parts: dict[str, DataFrame], column: str, name: str = "stage", written: list[str] | None = None) -> DataFrame:
    """As `materialize` of the union of ``parts`` by ``column``, which names them and holds one value in each: written
    part by part, so that no row is sorted into its folder."""
    import uuid
    first = next(iter(parts.values()))
    spark = first.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/skuflow-stages/{uuid.uuid4().hex[:12]}-{name}"
    (_STAGES if written is None else written).append(path)
    for value, df in parts.items():
        df.select(*first.columns).drop(column).write.mode("overwrite").parquet(f"{path}/{column}={value}")
    return spark.read.schema(first.schema).parquet(path).select(*first.columns)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def delete_stages(spark: SparkSession, written: list[str]) -> None:
    """Remove stage folders that `materialize` wrote; nothing may read them any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in written:
        at = hadoop.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    written.clear()


def release_stages(spark: SparkSession) -> None:
    """Delete every stage folder that this process has written and no pipeline owns (those of single
    operators, of the training-data queries and of the test-data adapter). DataFrames that read them end with it."""
    delete_stages(spark, _STAGES)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", event_log_dir: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skuflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.extraJavaOptions", "-Dlog4j2.level=ERROR")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")
    return spark
