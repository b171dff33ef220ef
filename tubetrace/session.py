"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join partitions even where that costs one more exchange: a hot
# business key would otherwise pin a third of the rows to one task.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # checkpoints of finished micro-batches go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # a stack walk per column expression costs more than small plans take to run
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app="tubetrace", master=None, shuffle_partitions=None, conf=None):
    """A session with the engine's defaults; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared checkpoint folder; make one only on a local master."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tubetrace-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written as a table in the shared folder: lineage ends there, and a lost
    executor costs at most the tasks that read what it held. Packed by column, the table takes a
    fraction of the disk of a checkpoint, and a reader takes only the columns it needs."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]):
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


STEP_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # the JVM never compiles a method of more bytes; the rules and counters of a stage make
    # longer ones, which Spark cuts in pieces under this limit
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


@contextmanager
def steps(spark: SparkSession):
    """A query in steps, so that its disk is that of its largest step: yields ``step``, which
    writes rows like ``stored``. The shuffle files of a step go as soon as it is written, and
    its table goes with the block unless it is ``kept``. ``partitions`` of the shuffles of a
    step are for large inputs, whose tasks would spill all they hold with the session's number.
    ``by`` names a column of few values that a reader picks rows by.
    """
    made = []

    def step(df: DataFrame, partitions: int | None = None, kept: bool = False,
             by: str | None = None) -> DataFrame:
        settings = dict(STEP_SETTINGS)
        if partitions:
            settings["spark.sql.shuffle.partitions"] = str(partitions)
        path = shared_folder(spark)
        if not kept:
            made.append(path)
        with _set(spark, settings):
            df.write.option("compression", "zstd").parquet(path, partitionBy=by)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield step
    finally:
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
