"""Linking records as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weft.operators import blocking, scoring
from weft.operators.registry import latest


def kafka_source(spark: SparkSession, servers: str, topic: str, schema: str) -> DataFrame:
    """JSON records of a topic; needs Spark's Kafka package on the cluster."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def change_records(raw: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Rows of a change feed's envelopes {op, ts_ms, after}: what stands after each insert, update or snapshot."""
    e = raw.select(F.from_json(F.col(value).cast("string"), f"op string, ts_ms bigint, after struct<{schema}>").alias("e"))
    return e.where("e.op in ('c', 'u', 'r') and e.after is not null").select("e.after.*", F.timestamp_millis("e.ts_ms").alias("changed_at"))


def link_batch(static: DataFrame, new: DataFrame, *, static_id: str, new_id: str, name: str, phonetic: str, region: str | None, threshold: float) -> DataFrame:
    """Matches of new records in the static registry. Scores have a fixed range: one batch's range would shift the threshold
    from batch to batch."""
    pairs = blocking.candidates(static, new, static_id, new_id, phonetic=phonetic, region=region, sort_key=name)
    scored = scoring.lexical_score(name)(scoring.hydrate(pairs, static, new, static_id, new_id, [c for c in (name, "region", "woreda", "zone") if c in static.columns and c in new.columns]))
    return scored.where(F.col("score") >= threshold)


def link_stream(stream: DataFrame, link: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, *, once: bool = True) -> StreamingQuery:
    """Each micro-batch linked and appended as Parquet under its batch number, so a batch that is run again replaces itself."""

    def each(df: DataFrame, batch: int) -> None:
        link(df).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def latest_stream(stream: DataFrame, key: str, order: str, out: str, checkpoint: str) -> StreamingQuery:
    """The latest version of each key over all batches so far."""

    def each(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        new = latest(df, key, [order])
        if batch:
            new = latest(spark.read.parquet(f"{out}/v={batch - 1}").unionByName(new), key, [order])
        new.write.mode("overwrite").parquet(f"{out}/v={batch}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str, key: str, *, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows of each key and window of event time; what comes later than the watermark is let go."""
    t = F.col(at).cast("timestamp")
    return stream.withColumn("__at", t).withWatermark("__at", late).groupBy(F.window("__at", width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")
