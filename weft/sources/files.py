"""Reading and writing tables."""

from __future__ import annotations

import json
import logging
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKENS = ["", "NA", "N/A", "n/a", "#N/A", "NaN", "nan", "null", "NULL", "None"]


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, *, infer: bool = False, null_tokens: list[str] = ()) -> DataFrame:
    """A CSV file with a header, quoted commas and line breaks allowed; all columns as text unless inferred."""
    r = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    if infer:
        df = r.option("inferSchema", True).csv(path)
    else:
        df = r.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(path) if columns else r.csv(path)
    if null_tokens:
        df = df.select(*[F.when(~F.col(f.name).isin(list(null_tokens)), F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema])
    return df


def extract(spark: SparkSession, path: str, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """A keyed extract: one row for each key, the last in the file's order of line numbers is not known to a cluster, so
    the largest row by all columns stands, which is the same on every run."""
    df = read_csv(spark, path, columns)
    row = F.struct(*df.columns)
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max(row).alias("__row")).select("__row.*")


def read_excel(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """One sheet of a workbook, read on the driver; needs pandas' optional reader."""
    import pandas as pd

    try:
        pdf = pd.read_excel(path, sheet_name=sheet, dtype=str)
    except ImportError as e:
        raise RuntimeError("reading a workbook needs openpyxl, which is not installed") from e
    return spark.createDataFrame(pdf.where(pdf.notna(), None), T.StructType([T.StructField(str(c), T.StringType()) for c in pdf.columns]))


def read_jdbc(spark: SparkSession, url: str, query: str, *, user: str | None = None, password_env: str | None = None) -> DataFrame:
    """A query of another database; the password comes from the environment."""
    r = spark.read.format("jdbc").option("url", url).option("query", query)
    if user:
        r = r.option("user", user)
    if password_env:
        r = r.option("password", os.environ.get(password_env, ""))
    return r.load()


def ping(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT 1 AS ok")


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    """One more batch; each part has its own header, so a batch that failed halfway leaves the others readable."""
    write_csv(df, path, mode="append")


def write_json_summary(df: DataFrame, path: str) -> None:
    """A one-row result as one JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def summary_json(df: DataFrame) -> str:
    """The single row of a summary as JSON text."""
    row = df.select(F.to_json(F.struct(*df.columns)).alias("j")).first()
    return json.dumps(json.loads(row["j"]), indent=2, ensure_ascii=False)


def write_table(df: DataFrame, name: str, keys: list[str]) -> None:
    """A saved table sorted by its keys, so that files skip by their ranges."""
    if not re.fullmatch(r"[A-Za-z_][\w.]*", name):
        raise ValueError(f"not a table name: {name}")
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").saveAsTable(name)


def upsert(existing: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Both tables as one, the latest version of each key; rows of equal version yield to the new."""
    from weft.operators.registry import latest

    both = existing.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    return latest(both, key, [version, "__new"]).drop("__new")


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, modified) of the files under a folder, sorted by path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).orderBy("path")


def log_to(path: str | None = None, level: str = "INFO") -> logging.Logger:
    """The driver's log, to its own output and, if a path is given, to a file as well; asked twice, it is set up once."""
    log = logging.getLogger("weft")
    log.setLevel(level)
    have = {getattr(h, "baseFilename", "") for h in log.handlers}
    for h in ([] if "" in have else [logging.StreamHandler()]) + ([logging.FileHandler(path)] if path and os.path.abspath(path) not in have else []):
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(h)
    return log


def write_jdbc(df: DataFrame, url: str, name: str, *, mode: str = "append", user: str | None = None, password_env: str | None = None) -> None:
    """A table of another database, written by all tasks; the password comes from the environment."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", name).mode(mode)
    if user:
        w = w.option("user", user)
    if password_env:
        w = w.option("password", os.environ.get(password_env, ""))
    w.save()
