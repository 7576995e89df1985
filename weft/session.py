"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, app: str = "weft", memory: str = "8g", **conf: str) -> SparkSession:
    """A session on this machine, for tests, the bench and the command line."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.driver.memory", memory)
    for k, v in {**LOCAL_CONF, "spark.sql.shuffle.partitions": str(cores), **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's spark.checkpoint.dir; one of our own only where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = os.path.join(tempfile.gettempdir(), "weft-shared")  # one machine: its own folder is shared by all
    return named.rstrip("/")


_written: list[tuple[SparkSession, str]] = []


def release(spark: SparkSession | None = None) -> None:
    """Delete what cut has written for a session (or all), once its results have been consumed."""
    for entry in [e for e in _written if spark is None or e[0] is spark]:
        own, path = entry
        _written.remove(entry)
        try:
            jvm = own._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(own._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session may have ended before us
            pass


atexit.register(release)


def cut(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write df to the shared folder and read it again: later jobs start from files that survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weft-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
