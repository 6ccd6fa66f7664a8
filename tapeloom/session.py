"""Sessions, and tables written to cut a lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", name: str = "tapeloom", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of this machine where the master is local."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), "tapeloom-checkpoints")
    spark.conf.set("spark.checkpoint.dir", "file://" + own)
    return "file://" + own


_written: list[str] = []


def forget(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes these tables that ``cut`` wrote, or all of this application; results that still read them are lost."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()  # noqa: SLF001 - the only way to the file system of the shared folder
    for name in [t.cut_path for t in tables] if tables else list(_written):
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        _written.remove(name)


@atexit.register
def _forget_at_end() -> None:
    spark = SparkSession.getActiveSession() if _written else None
    if spark is not None:
        try:
            forget(spark)
        except Exception:  # noqa: BLE001 - the session is gone already; the folder's owner clears it
            _written.clear()


def cut(df: DataFrame, label: str = "cut", files: int | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: computed once, and executors may be lost afterwards."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tapeloom/{label}-{uuid.uuid4().hex}"
    (df.coalesce(files) if files else df).write.parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out
