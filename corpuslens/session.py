"""Session settings and the place where intermediate tables are kept."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Recommended for text-heavy work. Arrow batches stay within 64 MB by Spark's own default.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("corpuslens")
    conf = {
        **CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point the session at its checkpoint folder.

    ``spark.checkpoint.dir`` names a folder that all executors share. Where it is unset a
    temporary folder is only good enough when driver and executors are one process.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpuslens-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


# Bytes of a batch of rows on its way to a Python worker.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python workers in Arrow batches of about 4 MB, or of one longer row.

    An executor holds a batch of each task several times outside its heap: the vectors, twice
    while they grow, the message that is being sent, and the rows in the worker. At Spark's
    64 MB that is some hundred MB a task. The setting stays in the session, since a DataFrame
    that was made under it runs later.
    """
    spark.conf.set(BATCH_BYTES, "4m")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it from there afterwards.

    Used where later steps must see exactly the same rows, also when an executor is lost in
    between, or where computing them again would cost more than reading them. A parquet
    table rather than a checkpointed RDD: later steps read only the columns they need, and
    the planner knows the size.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
