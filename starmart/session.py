"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
from functools import lru_cache

from pyspark.sql import SparkSession

# Runtime re-planning does the partition sizing and skew splitting for every
# shuffle in the package, so it is switched on whatever the cluster default is.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


PARTITION_BYTES = 128 << 20
DEFAULT_PARTITIONS = 200  # Spark's own
EXPLICIT_SIZE = "spark.starmart.largestShuffleBytes"  # set where the caller has named a size


def shuffle_partitions(size: int) -> int:
    """Partitions of about 128 MiB, and never fewer than Spark's own default of 200."""
    return max(DEFAULT_PARTITIONS, -(-size // PARTITION_BYTES))


def create_session(
    app_name: str = "starmart",
    *,
    master: str | None = None,
    packages: str | None = None,
    hive: bool = False,
    largest_shuffle_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; ``packages`` may name a jar for an extra fact format.

    ``largest_shuffle_bytes`` is about the size of the largest table that is shuffled. It
    sets the number of shuffle partitions, so that one fits in a task's memory; adaptive
    execution merges small partitions again, but does not split large ones of even size.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if packages:
        builder = builder.config("spark.jars.packages", packages)
    settings = dict(ADAPTIVE_CONF)
    if largest_shuffle_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(largest_shuffle_bytes))
        settings[EXPLICIT_SIZE] = str(largest_shuffle_bytes)
    for key, value in {**settings, **(conf or {})}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"starmart-{application}-")
