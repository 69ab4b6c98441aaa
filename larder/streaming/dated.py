"""A stream into days, each event once, with late rows set aside.

Every batch is one commit: its rows go below the batch's number, on time and late ones apart, and a small row of
facts comes last. A batch that is run again writes the same places. Days that the watermark has passed get no more rows
and are folded into one set of files; until then a day has a few files per batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from larder.session import exists, folders

DAY, BATCH = "event_date", "batch"


class DatedSink:
    """Folder of a stream's days: ``open`` by day and batch, ``done`` by day, ``late`` and ``commits`` by batch."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, keys: Sequence[str], ts: str = "ts", wait: timedelta = timedelta(days=1)):
        self.spark, self.folder, self.schema, self.keys, self.ts, self.wait = spark, folder.rstrip("/"), schema, [*keys], ts, wait
        self.kind = schema[ts].dataType

    def _read(self, part: str, *more: StructField) -> DataFrame:
        schema = StructType([*self.schema.fields, *more])
        path = f"{self.folder}/{part}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def _open(self) -> DataFrame:
        return self._read("open", StructField(DAY, DateType()), StructField(BATCH, LongType()))

    def _days(self, part: str) -> set[date]:
        names = (f.partition("=")[2] for f in folders(self.spark, f"{self.folder}/{part}") if f.startswith(f"{DAY}="))
        return {date.fromisoformat(n) for n in names if n[:1].isdigit()}

    def watermark(self, before: int | None = None) -> datetime | None:
        """Latest event time of the batches committed (before one), less the time that late rows are waited for."""
        batches = [int(f.partition("=")[2]) for f in folders(self.spark, f"{self.folder}/commits")]
        batches = [b for b in batches if before is None or b < before]
        if not batches:
            return None
        facts = self.spark.read.schema("latest timestamp_ntz").parquet(f"{self.folder}/commits/{BATCH}={max(batches)}").first()
        return facts.latest - self.wait if facts.latest else None

    def rows(self) -> DataFrame:
        """All rows on time, each key once."""
        done = self._days("done")
        still = self._open().where(~F.col(DAY).isin([*done]) if done else F.lit(True)).select(*self.schema.names)
        return self._read("done").select(*self.schema.names).unionByName(still)

    def late(self) -> DataFrame:
        """Rows that came after the watermark had passed their time, or have no time, with the batch that brought them."""
        return self._read("late", StructField(BATCH, LongType()))

    def write_batch(self, rows: DataFrame, number: int) -> None:
        """Commit one batch. Its outcome depends on its rows and on the batches before it, so a repetition gives the same."""
        at = F.col(self.ts).cast("timestamp_ntz")
        mark = self.watermark(before=number)
        on_time = F.coalesce(at >= F.lit(mark).cast("timestamp_ntz"), F.lit(False)) if mark else at.isNotNull()
        fresh = rows.where(on_time).withColumn(DAY, F.col(self.ts).cast("date")).dropDuplicates(self.keys)
        if mark:  # a key can only repeat one of the days that are still open
            known = self._open().where((F.col(DAY) >= F.lit(mark.date())) & (F.col(BATCH) < number)).select(*self.keys)
            same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in self.keys]
            fresh = fresh.alias("n").join(known.alias("o"), same, "left_anti")
        self._put(fresh.withColumn(BATCH, F.lit(number)), "open", [DAY, BATCH], [DAY])
        self._put(rows.where(~on_time).withColumn(BATCH, F.lit(number)), "late", [BATCH], [])
        latest = rows.agg(F.max(at).alias("latest")).first().latest
        known_latest = mark + self.wait if mark else None
        latest = max((x for x in (latest, known_latest) if x), default=None)
        facts = self.spark.createDataFrame([(latest, number)], f"latest timestamp_ntz, {BATCH} long")
        self._put(facts, "commits", [BATCH], [])
        self.fold_days()

    def _put(self, df: DataFrame, part: str, by: list[str], balance: list[str]) -> None:
        if balance:
            df = df.hint("rebalance", *balance)
        else:
            df = df.hint("rebalance")
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.folder}/{part}")

    def fold_days(self) -> list[date]:
        """Fold the days that the watermark has passed into few files. A day counts as folded once its folder is there."""
        mark = self.watermark()
        ready = sorted(d for d in self._days("open") - self._days("done") if mark and d < mark.date())
        if ready:
            self._put(self._open().where(F.col(DAY).isin(ready)).drop(BATCH), "done", [DAY], [DAY])
        return ready


def load_stream(source: DataFrame, sink: DatedSink, checkpoint: str) -> None:
    """Work off what a streaming DataFrame has and stop; ``checkpoint`` remembers what has been read."""
    run = (
        source.writeStream.foreachBatch(lambda rows, number: sink.write_batch(rows, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
