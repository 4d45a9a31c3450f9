"""Session defaults and the shared folder that jobs cut their lineage with."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "lodeplane", cores: str = "8", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which driver and executors share; one of our own only where none is set and the master is local."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """Bytes of an Arrow batch on its way to Python, unless the session names them: memory of texts, and no result, depends on them."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == f"{64 << 20}b":  # Spark's own default
        spark.conf.set(key, size)


#: Folders of tables that this process has stored.
_stored: list[str] = []


def stored(df: DataFrame, what: str) -> DataFrame:
    """df as a Parquet table in the shared checkpoint folder, read again: a fixed table that later jobs can scan twice and that outlives executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/lodeplane-{what}-{uuid.uuid4().hex}"
    _stored.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables that this process has stored so far; call it when no result that reads them is needed any more."""
    n = 0
    while _stored:
        path = spark._jvm.org.apache.hadoop.fs.Path(_stored.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def spread(df: DataFrame) -> DataFrame:
    """df dealt to all cores if it is a scan of fewer partitions: for work that costs more than moving the rows. A large table stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def evened(df: DataFrame) -> DataFrame:
    """Narrow rows dealt evenly to a fixed number of partitions: a scan's partitions say nothing of its row groups, so that few of them may hold all rows."""
    return df.repartition(_fixed(df.sparkSession))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to a fixed number of partitions, which stay as they are however few bytes they hold: for joins whose work is in their pairs, not in their bytes."""
    return df.repartition(_fixed(df.sparkSession), *keys)


def dealt_keys(spark: SparkSession, least: float) -> int:
    """How many groups to deal keys to, where `least` groups would be large enough: at least one for each of a fixed number of partitions."""
    return max(_fixed(spark), math.ceil(least))


def _fixed(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)


def paired(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left joined with right on keys, both dealt and sorted: neither is sent whole to the driver or a task, and no partition takes others' pairs on."""
    return dealt(left, *keys).join(dealt(right, *keys).hint("merge"), keys, how)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there; survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
