"""Sessions, the shared scratch folder, and shipping this package to executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


BATCH_ROWS = 1000  #: rows of an Arrow batch


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "furrow") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only where a session on one machine (tests) has none, a temporary folder is set; a cluster without one is an error.
    """
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="furrow-checkpoints-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table written to the shared folder and read again: it cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = place(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{scratch(spark).rstrip('/')}/furrow-{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    if not hasattr(context, "_furrow_paths"):
        context._furrow_paths = []
        atexit.register(clean, spark)
    context._furrow_paths.append(path)
    return path


def clean(spark: SparkSession) -> None:
    """Delete all intermediate tables of this session; results that still read them are lost."""
    paths = getattr(spark.sparkContext, "_furrow_paths", [])
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        while paths:
            path = jvm.org.apache.hadoop.fs.Path(paths.pop())
            path.getFileSystem(conf).delete(path, True)
    except Exception:  # the JVM may have gone first; nothing depends on the deletion
        paths.clear()


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, wherever the driver was started."""
    context = spark.sparkContext
    # Rows here hold whole documents: batches of Spark's default 10,000 rows would be tens of MB on each side of the socket.
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") in (None, "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if getattr(context, "_furrow_shipped", False):
        return
    here = Path(__file__).resolve().parent
    to = os.path.join(tempfile.mkdtemp(prefix="furrow-"), "furrow.zip")
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, f"furrow/{p.relative_to(here)}")
    context.addPyFile(to)
    context._furrow_shipped = True
