"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Joins carry no broadcast hints: the planner broadcasts a side only when its
# measured size is under autoBroadcastJoinThreshold, first from file statistics
# and again at run time from shuffle statistics. Skewed joins beyond that are
# split by AQE; forced, also where a later aggregation or window would otherwise
# reuse the join's partitioning and keep a busy key in one task.
QUERY_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stores replace the periods they write and no others.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
SETTINGS = {**QUERY_SETTINGS, "spark.ui.enabled": "false"}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on in a session built elsewhere."""
    for name, value in QUERY_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


# Queries read few columns, so a shuffle moves well under a gigabyte of the
# input per partition at this ratio, and sorts that exceed memory spill.
INPUT_PER_PARTITION = 1 << 30


def sized_settings(input_bytes: int) -> dict[str, str]:
    """Shuffle width for an input: wide at first, narrowed by AQE where little is left."""
    partitions = max(200, -(-input_bytes // INPUT_PER_PARTITION))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
    }


# Of the warehouse tables' input, Parquet bytes for each shuffle partition at first and
# for each bucket of a stored table. An item of 15 bytes there is a game row of 400 in a
# task, and pairs of players are more still.
WIDTH_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
# And for each part of a first load: the shuffles of one part are on disk at a time.
PART_BYTES = 512 << 20

# Queries on the warehouse tables widen rows after a shuffle, so little of it is read
# by a task, and little of a file; AQE merges partitions up to this size, no further.
INPUT_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.files.openCostInBytes": "1MB",
}
INITIAL_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
INPUT_READ = "tidemark.input.bytes"


def fit_input(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles start with more partitions where the input is larger, never fewer."""
    settings = {**INPUT_SETTINGS, INPUT_READ: str(input_bytes)}
    asked = int(spark.conf.get(INITIAL_WIDTH, None) or 0)
    wanted = -(-input_bytes // WIDTH_BYTES)
    if wanted > max(asked, int(spark.conf.get("spark.sql.shuffle.partitions"))):
        settings[INITIAL_WIDTH] = str(wanted)
    for name, value in settings.items():
        spark.conf.set(name, value)


def buckets_for(spark: SparkSession, least: int) -> int:
    """Buckets for new stored tables: as many as the input that was read asks for.

    Where shuffles are as wide, their width is a multiple of it, so that a partition of rows
    that were grouped by what a table is bucketed by holds one bucket.
    """
    wanted = max(least, -(-int(spark.conf.get(INPUT_READ, "0")) // BUCKET_BYTES))
    width = int(spark.conf.get(INITIAL_WIDTH, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    return next((n for n in range(wanted, width + 1) if width % n == 0), wanted)


def parts_for(spark: SparkSession) -> int:
    """Parts that a first load is stored in, as many as the input that was read asks for."""
    return max(1, -(-int(spark.conf.get(INPUT_READ, "0")) // PART_BYTES))


def get_session(
    app_name: str = "tidemark",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session; ``master`` is left to spark-submit unless given.

    Pass ``sized_settings(...)`` as settings for large inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only a local master may go without.

    Executors on other machines cannot see a local folder, so an unset folder is
    an error anywhere but on ``local[...]``.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(folder)
    return folder
