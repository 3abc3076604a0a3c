"""Session settings every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings. None of them sizes the cluster: shuffle width, memory
# and executors stay with whoever submits the job; AQE adapts partition counts.
RUNTIME_CONF = {
    # All instants and DATE(ts) truncations are UTC.
    "spark.sql.session.timeZone": "UTC",
    # A bad cast is an error unless try_cast says otherwise.
    "spark.sql.ansi.enabled": "true",
    # Re-plan with real sizes: coalesce small shuffle partitions, split the
    # partitions of hot keys in joins and rebalances.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size checks for broadcasts go by file size; Parquet unpacks to several
    # times that, and a side must fit the threshold unpacked.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # The JIT compiler skips methods over 8000 bytes of bytecode; a stage that
    # generates one runs faster as separate, compiled operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Upserts rewrite only the date partitions they touch.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "hazardgrid", **conf: str) -> SparkSession:
    """Session for scripts and tests; clusters normally pass their own."""
    builder = SparkSession.builder.appName(app_name)
    # Static, so only possible here: recording a Python call site for every
    # column expression takes longer than planning the query.
    static = {"spark.python.sql.dataFrameDebugging.enabled": "false"}
    for key, value in {**static, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _store(spark: SparkSession, path: str):
    """A path and the file system it is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    place, store = _store(spark, path)
    if not store.exists(place):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of UTF-8 text."""
    place, store = _store(spark, path)
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file that readers see whole or not at all; an existing one is an error."""
    place, store = _store(spark, path)
    if store.exists(place):
        raise FileExistsError(path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.new")
    stream = store.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not store.rename(hidden, place):
        raise FileExistsError(path)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting may fall back, to a folder
    in its warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        fallback = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"
        spark.sparkContext.setCheckpointDir(fallback)
        return fallback
    raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
