"""Session settings. Jobs take whatever session they are given; these are the
settings they are meant to run under."""

from pyspark.sql import SparkSession

# Adaptive execution picks partition counts, splits skewed join partitions and
# turns joins into broadcasts from measured sizes. The static broadcast limit
# stays at Spark's default: nothing in this package forces a broadcast of a
# table that grows with the input.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: str = "8", app_name: str = "medclaims", memory: str = "8g") -> SparkSession:
    """A small local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
