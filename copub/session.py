"""Session helpers: scratch location and recommended settings.

Operators never create or configure a session; the caller owns it.  Writers
that need a scratch location (round trips, streaming sinks) use the shared
folder the cluster names in ``spark.checkpoint.dir``; where that is unset, a
local master (tests) uses the temporary folder and a cluster is refused.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a deployment is expected to use.  AQE re-plans joins and
# partition counts at run time and splits skewed sort-merge-join partitions;
# shuffles are sized by bytes per partition (AQE coalesces the many initial
# partitions), so the same settings hold from a laptop to a large cluster.
# For ~100 TB of input: scan splits of 256 MB, a high initial shuffle
# partition count (AQE coalesces it down to ~256 MB partitions).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}

# Initial shuffle partitions for a ~100 TB job on ~1000 executors.
LARGE_CLUSTER_SHUFFLE_PARTITIONS = 40_000


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; only a local master may do without one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.gettempdir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint root for one write."""
    return f"{checkpoint_root(spark)}/copub/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the path as its object."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


LISTED_FILES = 256  # beyond as many, sizes are taken by folder


def input_bytes(rows: DataFrame) -> int:
    """Bytes of the files that ``rows`` are read from, be it through joins; 0 where there are none.  No job."""
    spark, files = rows.sparkSession, sorted(set(rows.inputFiles()))
    if len(files) > LISTED_FILES:
        files = sorted({f.rsplit("/", 1)[0] for f in files})
    total = 0
    for name in files:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(name))
        total += where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    return total


def tasks_for(rows: DataFrame, bytes_per_task: int, least: int | None = None) -> int:
    """Partitions for a step whose rows are many more than the bytes before it tell, so that AQE, which
    goes by these, would leave it too few: by the input's size, at least ``least`` (the session's shuffle partitions)."""
    if least is None:
        least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(-(-input_bytes(rows) // bytes_per_task), LARGE_CLUSTER_SHUFFLE_PARTITIONS))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours, in whatever store it lies; a missing one is no error."""
    fs, where = file_system(spark, path)
    fs.delete(where, True)
