"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# UTC keeps timestamp <-> timestamp_ntz casts free of offsets; AQE re-plans joins
# and splits skewed partitions from real sizes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM leaves methods above 8000 bytes uncompiled.  Rows of some 60 columns get
    # there in one fused stage and then run four times slower than unfused operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("watthour")
    settings = {
        **DEFAULTS,
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        **conf,
    }
    for name, setting in settings.items():
        builder = builder.config(name, setting)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Set and return the checkpoint folder that the cluster names; None where it names none.

    A folder of the driver's own would be unreachable for executors, so none is made.
    """
    current = spark.sparkContext.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if current is None and named:
        spark.sparkContext.setCheckpointDir(named)
        current = named
    return current


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share.

    It is the one in ``spark.checkpoint.dir``.  A local session, all of whose tasks see the
    driver's disk, gets one of its own where none is named; elsewhere that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="watthour-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a frame from ``written`` that nothing reads any more."""
    spark = df.sparkSession
    ours = shared_folder(spark).partition(":")[2].lstrip("/") or shared_folder(spark).lstrip("/")
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if folder.partition(":")[2].lstrip("/").startswith(ours + "/"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
