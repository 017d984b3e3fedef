"""Keeping a summary up to date as files arrive."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daymill.operators.summaries import MONEY, daily_summary
from daymill.operators.upsert import upsert_table
from daymill.plans.tables import create_summary
from daymill.sinks import storage

# Days as batches have them.
PARTS = f"summary_date DATE, order_cnt BIGINT, total_amount {MONEY}"


# Batches whose manifests and folders are kept.
KEPT = 4


@dataclass(frozen=True)
class Level:
    """A folder, below the checkpoint, with the days of so many batches."""

    folder: str
    batches: int


class Levels:
    """The counts and sums of all batches so far, in folders whose number grows with the logarithm.

    Each batch adds a folder of its own. As soon as the last folders stand for
    as many batches as the one before them, they are added up into one, so a
    day is carried over to a new folder once for each doubling. A manifest for
    each batch names the folders that together hold it and all before it; it is
    published after they are written, so a failure on the way changes nothing.
    The last manifests are kept, as a batch that is repeated needs the one before.
    """

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.root = spark, checkpoint.rstrip("/")

    def own(self, batch_id: int) -> str:
        return f"daily_parts/batch={batch_id}"

    def _manifest(self, batch_id: int) -> str:
        return f"{self.root}/daily_levels/{batch_id:012d}.json"

    def _batches(self) -> list[int]:
        names = storage.names_in(self.spark, f"{self.root}/daily_levels")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def _named(self, batch_id: int) -> list[Level]:
        return [Level(**x) for x in json.loads(storage.read_text(self.spark, self._manifest(batch_id)))]

    def before(self, batch_id: int) -> list[Level]:
        """The folders of all earlier batches. Without a manifest, each has its own."""
        known = [b for b in self._batches() if b < batch_id]
        if known:
            return self._named(known[-1])
        names = storage.names_in(self.spark, f"{self.root}/daily_parts")
        own = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
        return [Level(self.own(b), 1) for b in own if b < batch_id]

    def read(self, levels: list[Level]) -> DataFrame:
        if not levels:
            return self.spark.createDataFrame([], PARTS)
        return self.spark.read.schema(PARTS).parquet(*(f"{self.root}/{x.folder}" for x in levels))

    def add(self, batch_id: int) -> list[Level]:
        """Count a batch in, whose own folder is written; returns the folders from now on."""
        if batch_id in self._batches():
            return self._named(batch_id)
        levels = self.before(batch_id)
        last = [Level(self.own(batch_id), 1)]
        while levels and levels[-1].batches <= sum(x.batches for x in last):
            last.insert(0, levels.pop())
        if len(last) > 1:
            folder = f"daily_levels/sum-{uuid.uuid4().hex}"
            added_up(self.read(last)).write.parquet(f"{self.root}/{folder}")
            last = [Level(folder, sum(x.batches for x in last))]
        levels += last
        storage.publish_text(self.spark, json.dumps([asdict(x) for x in levels]), self._manifest(batch_id))
        self._tidy()
        return levels

    def _tidy(self) -> None:
        """Remove manifests before the last few, and folders that only they name."""
        batches = self._batches()
        old, kept = batches[:-KEPT], batches[-KEPT:]
        needed = {x.folder for b in kept for x in self._named(b)} | {self.own(b) for b in kept}
        for batch in old:
            for folder in {x.folder for x in self._named(batch)} | {self.own(batch)}:
                if folder not in needed:
                    storage.remove(self.spark, f"{self.root}/{folder}")
            storage.remove(self.spark, self._manifest(batch))


def added_up(parts: DataFrame) -> DataFrame:
    return parts.groupBy("summary_date").agg(
        F.sum("order_cnt").alias("order_cnt"),
        F.sum("total_amount").cast(MONEY).alias("total_amount"),
    )


def touched_totals(parts: DataFrame, batch_id: int) -> DataFrame:
    """Totals over all batches of the days that a batch has rows in."""
    days = parts.where(F.col("batch") == batch_id).select("summary_date")
    return added_up(parts.join(days, "summary_date", "left_semi"))


def run_incremental_summary(
    spark: SparkSession,
    source: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    ts: str = "order_dt",
    amount: str = "amount",
    zone: str | None = None,
    as_of: datetime | None = None,
    max_files: int | None = None,
) -> None:
    """Process all files not processed yet, then stop.

    Every file is read once. A batch leaves its counts and sums per day in a
    folder of its own below the checkpoint, and the days it has are then summed
    up over all batches and upserted. Folders are merged as batches go on, see
    ``Levels``, so of n batches about log n folders are read. Late rows thus
    mend their day. A batch that is repeated after a failure replaces its own
    counts, and so changes nothing. The sums go with the checkpoint: whoever
    starts over without it starts over as a whole. A checkpoint made before
    there were such counts has none of its earlier batches, and must be started
    over too.
    """
    create_summary(spark, table)

    def load(batch: DataFrame, batch_id: int) -> None:
        levels = Levels(batch.sparkSession, checkpoint)
        own = Level(levels.own(batch_id), 1)
        found = daily_summary(batch, ts, amount, zone=zone)
        found.write.mode("overwrite").parquet(f"{levels.root}/{own.folder}")
        earlier = levels.read(levels.before(batch_id)).withColumn("batch", F.lit(-1))
        parts = earlier.unionByName(levels.read([own]).withColumn("batch", F.lit(batch_id)))
        upsert_table(touched_totals(parts, batch_id), table, as_of=as_of)
        levels.add(batch_id)

    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.parquet(source)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .start()
    )
    query.awaitTermination()
