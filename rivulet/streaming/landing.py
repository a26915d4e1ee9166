"""Landed-file streams: bronze append, keep-best upsert, daily windows, late rows.

All of them run with ``availableNow``: a scheduled run picks up what has landed
since the last one and stops. State is the checkpoint folder, so a lost run is
repeated from there.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.functions.clean import nan_to_null, snap
from rivulet.operators.dedup import Order, first_per_key
from rivulet.operators.refresh import latest
from rivulet.sources.files import payload_rows
from rivulet.sources.records import file_lines
from rivulet.sources.tables import changed_rows, exists, read_table, settle, upsert_table

MARK = "top date, seen date"


def ingest_payloads(spark: SparkSession, path: str, table: str, checkpoint: str) -> StreamingQuery:
    """Append landed CSV files to a bronze table, exactly once per file, columns by name.

    Each file is read by its own header and delimiter, so a file with other or reordered
    columns lands right; columns are text, '' is NULL. A batch has a folder of its own, which a
    repeated batch overwrites; ``read_table`` gives all of them, with the column ``batch``.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        rows = payload_rows(batch)
        if rows is not None:
            rows.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return (file_lines(spark.readStream, path).writeStream.foreachBatch(land)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def ingest_stream(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append what has landed to a bronze table, exactly once per file."""
    return (stream.writeStream.format("parquet").option("path", table)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def split_late(batch: DataFrame, day: str, high_water, horizon: int
               ) -> tuple[DataFrame, DataFrame]:
    """(in time, late): late rows are older than the stored maximum minus the horizon."""
    if high_water is None:
        return batch, batch.limit(0)
    cut = F.lit(str(high_water - timedelta(days=horizon))).cast("date")
    late = F.coalesce(F.col(day) < cut, F.lit(False))
    return batch.where(~late), batch.where(late)


def stream_upsert(stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str],
                  best: Order, day: str, horizon: int = 21, rejects: str | None = None
                  ) -> StreamingQuery:
    """Corrections inside the horizon replace stored rows, the best of a batch wins.

    Rows older than the horizon go to ``rejects`` with the reason LATE. The latest day seen
    is state beside the checkpoint, a mark per batch: a batch splits by what the marks
    before it say, so a batch that is repeated after a crash gives what it gave, and the table
    is asked for its latest day once, before the first batch. Rows that the table holds
    already are no corrections: only the others are written, into their years, and a batch
    without any writes nothing.
    """
    marks = f"{checkpoint.rstrip('/')}__marks"

    def mark(batch: DataFrame, batch_id: int):
        spark, place = batch.sparkSession, f"{marks}/batch={batch_id}"
        if not exists(spark, f"{place}/_SUCCESS"):
            before = f"{marks}/batch={batch_id - 1}"
            if exists(spark, f"{before}/_SUCCESS"):
                top = spark.read.schema(MARK).parquet(before).select(F.greatest("top", "seen")).first()[0]
            else:
                top = latest(read_table(spark, table), day) if exists(spark, table) else None
            seen = latest(batch, day)
            (spark.createDataFrame([(top, seen)], MARK).coalesce(1).write.mode("overwrite").parquet(place))
        return spark.read.schema(MARK).parquet(place).first()["top"]

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = settle(batch, "stream")
        top = mark(batch, batch_id)
        current, late = split_late(batch, day, top, horizon)
        if rejects is not None:
            (late.withColumn("rejection_reason", F.lit("LATE")).write.mode("overwrite")
             .parquet(f"{rejects}/batch={batch_id}"))
        fresh = settle(changed_rows(first_per_key(current, keys, best), table, day), "corrections")
        if not fresh.isEmpty():
            upsert_table(fresh, table, keys, day, sort=keys)

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_hourly_to_daily(stream: DataFrame, time: str = "time", kelvin: str = "t2m",
                           delay: str = "1 day", digits: int = 2) -> DataFrame:
    """Daily mean, minimum and maximum per cell; a day is emitted once it is closed."""
    celsius = nan_to_null(F.col(kelvin).cast("double")) - 273.15
    readings = stream.select(F.col(time).cast("timestamp").alias("_ts"),
                             snap("latitude").alias("latitude"),
                             snap("longitude").alias("longitude"), celsius.alias("_t"))
    daily = (readings.withWatermark("_ts", delay)
             .groupBy(F.window("_ts", "1 day"), "latitude", "longitude")
             .agg(F.avg("_t").alias("mean"), F.min("_t").alias("low"), F.max("_t").alias("high")))
    return (daily.where(F.col("mean").isNotNull())
            .select(F.to_date("window.start").alias("time"), "latitude", "longitude",
                    F.bround("mean", digits).alias("t2m_mean"),
                    F.bround("low", digits).alias("t2m_min"),
                    F.bround("high", digits).alias("t2m_max")))
