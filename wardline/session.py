"""Session settings the reports rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All are runtime SQL settings. The skew settings matter most: joins go to the
# key as it is, and a key that holds a large share of the rows is split by
# adaptive execution, even where that costs the aggregate above another shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Where the restricting side of a join is too large to broadcast, a bloom filter of its
    # keys drops rows of observations and payments before they are shuffled. Both bounds are on
    # sizes that Spark estimates; the filter itself has a fixed size limit.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "2GB",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the adaptive-execution options on an existing session."""
    for key, value in ADAPTIVE.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A single-machine session for the tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
