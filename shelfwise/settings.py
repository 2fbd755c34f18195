"""Defaults of the case, and the session the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Results depend on these defaults; every operator takes them as parameters.
UNMAPPED_LABEL = "⚠️ UNMAPPED (Missing SKU)"
UNMAPPED_CATEGORY = "Beverages"
UNMAPPED_BRAND = "Beverama"
UNMAPPED_SEGMENT = "Unknown"
UNKNOWN_CITY = "Unknown"
UNKNOWN_BRAND = "Unknown"
LAST_YEAR = 2019
CITY_COORDINATES = {
    "Detroit": (42.3314, -83.0458),
    "Fargo": (46.8772, -96.7898),
    "Milwaukee": (43.0389, -87.9065),
    "Minneapolis": (44.9778, -93.2650),
    "Omaha": (41.2565, -95.9345),
}
DEFAULT_COORDINATES = (39.82, -98.57)
ACTUAL_TYPE = "Actual Revenue"
FORECAST_TYPE = "Machine Learning Forecast"
GROWTH = "organic growth"
CONTRACTION = "contraction"
INSUFFICIENT = "insufficient data"
MIN_TRAINING_MONTHS = 5
FORECAST_STEPS = 6
FORECAST_TREES = 100
FORECAST_DEPTH = 3
FORECAST_SEED = 42

# Money is summed as decimals: the sum does not depend on row order, so a retried task gives the same cents.
PRICE_PRECISION = 18
PRICE_SCALE = 6


# Bytes a shuffle partition should hold: sorts and hash tables of that size stay in executor memory.
SHUFFLE_PARTITION_BYTES = 200 * 1024 * 1024
# Splits and merged partitions, whatever the size of the input: a tile reads a few columns of each split.
SPLIT_BYTES = 256 * 1024 * 1024
ADVISORY_BYTES = 128 * 1024 * 1024
# Spark judges a dimension by the size of its Parquet files. As rows in memory, names and categories that repeat take
# some thirty times as much, so sizes are multiplied by this before they are compared with the broadcast threshold.
IN_MEMORY_FACTOR = 30
BROADCAST_BYTES = 128 * 1024 * 1024
# A load shuffles lines again for tables it makes from stored months, in so many portions, that the shuffle files of one
# are gone before those of the next are written. A load below the size of a portion is one portion.
PORTIONS, PORTION_BYTES = 6, 16 * 1024 * 1024
STORED_FILES = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}  # stored tables, whatever the session's codec


def size_settings(input_bytes: int) -> dict[str, str]:
    """Settings that depend on the size of the sales feed. Adaptive execution merges partitions that end up small,
    so the number only has to be large enough."""
    return {"spark.sql.shuffle.partitions": str(max(200, -(-input_bytes // SHUFFLE_PARTITION_BYTES)))}


def session(
    app_name: str = "shelfwise", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the operators rely on for speed (none is needed for right results).

    Pass ``input_bytes``, the size of the sales feed, where the default of 200 shuffle partitions is too few.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        # Splits the partition of a hot key when a dimension is too large to broadcast.
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Dimensions are read from Parquet, so Spark knows their size; above this it sort-merges instead.
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_BYTES),
        "spark.sql.sources.fileCompressionFactor": str(IN_MEMORY_FACTOR),
        "spark.sql.files.maxPartitionBytes": str(SPLIT_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ADVISORY_BYTES),
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **(size_settings(input_bytes) if input_bytes is not None else {}),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
