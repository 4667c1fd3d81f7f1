"""Session settings and shared scratch space."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: File system and path of every scratch table.
_scratch: list[tuple] = []


def build_session(app: str = "glyphline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # checkpoints go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir. A machine-local folder is
    used only when nothing is set and the session itself is local."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.removeprefix("file:").rstrip("/")
    return tempfile.mkdtemp(prefix="glyphline-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table. It is deleted when the driver ends,
    as a lazy result may be read until then."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(remove_scratch)
    # the file system is looked up now: when the driver ends, the session may have ended before
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    _scratch.append((where.getFileSystem(spark._jsc.hadoopConfiguration()), where))
    return path


def remove_scratch() -> None:
    """Delete the scratch tables of this driver, through the file system that holds them."""
    while _scratch:
        files, where = _scratch.pop()
        try:
            files.delete(where, True)
        except Exception:  # noqa: BLE001  the connection to the session's process is gone: nothing can be done
            return


def part_count(df: DataFrame, least: int) -> int:
    """In how many parts to deal out a frame's rows: as many as its files are read in, and ``least`` at least."""
    return max(least, df.rdd.getNumPartitions())


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
