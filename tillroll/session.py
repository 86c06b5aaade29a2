"""Session settings suited to these jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings applied by ``configure``; each is a plain Spark SQL option.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    for key, value in DEFAULT_CONF.items():
        spark.conf.set(key, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillroll", event_log_dir: str | None = None
) -> SparkSession:
    """A local session for tests and benchmarks (UI off; optional event log
    for stage and task times)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark, shuffle_partitions)


def input_bytes(df) -> int:
    """Size of the files that ``df`` scans, as Spark listed them when the scan
    was planned (no further file-system calls); 0 when it reads no files."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = (leaves.apply(i) for i in range(leaves.size()))
    return sum(int(str(leaf.stats().sizeInBytes())) for leaf in sizes if "Relation" in leaf.nodeName())


def size_shuffles(spark: SparkSession, nbytes: int, bytes_per_partition: int = 256 << 20) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to one partition per
    ``bytes_per_partition`` of input (never lower it).  AQE then coalesces
    partitions that turn out small, so the setting only has to be large enough
    that no shuffle partition (or output file) is huge."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-nbytes // bytes_per_partition)
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
        return wanted
    return current
