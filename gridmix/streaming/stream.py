"""The daily tables as a stream of landed files (Structured Streaming).

Each micro-batch adds the exact partial sums of its rows to a ledger, one folder
per batch, and puts the days they touch into both daily tables. Everything a
batch does is a function of the ledger up to that batch, and its own folder is
replaced as a whole, so a batch that is replayed (the driver or an executor was
lost after some writes, before the stream's own commit) changes nothing: the
tables equal a full rebuild from all landed rows, in whatever files and order
these came.

Every ``COMPACT_EVERY`` batches the ledger's sums are added up into a base, and
folders older than the base before are removed. Two bases stay, so that a replay
of the batch that made the newest one starts from the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix import schemas
from gridmix.constants import ROLLING_ROWS
from gridmix.operators.aggregates import add_partials, daily_partials, rollup_of
from gridmix.operators.joins import matching
from gridmix.sources.sinks import Staging, finished, folders, remove
from gridmix.streaming.incremental import put_changed, touched_days

COMPACT_EVERY = 20


class DailyLedger:
    """Partial sums of the batches of one stream, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, stream: str, compact_every: int = COMPACT_EVERY,
                 **partial_params) -> None:
        """``stream`` is the id that the stream's checkpoint keeps. A ledger of another stream
        is refused: with a new checkpoint all files come again and would count twice."""
        others = [name for name in folders(spark, path) if name != f"stream={stream}"]
        if others:
            raise RuntimeError(f"the ledger {path} belongs to another stream ({others[0]}): its checkpoint "
                               "was replaced. Start with a new ledger and new tables, or restore the checkpoint")
        self.spark, self.root = spark, f"{path.rstrip('/')}/stream={stream}"
        self.compact_every, self.partial_params = compact_every, partial_params

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the finished folders ``<kind>-<number>``, ascending."""
        names = [n for n in folders(self.spark, self.root) if n.startswith(f"{kind}-")]
        return sorted(int(n.split("-")[1]) for n in names if finished(self.spark, f"{self.root}/{n}"))

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{name}" for name in names])

    def record(self, rows: DataFrame, batch: int) -> DataFrame:
        """Put the sums of a batch in its folder, in place of what a broken run left there."""
        path = f"{self.root}/batch-{batch}"
        daily_partials(rows, **self.partial_params).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def upto(self, batch: int) -> DataFrame:
        """Sums of all rows of the batches up to ``batch``, one row per key.

        They are the newest base of earlier batches and the folders since: at most
        twice ``COMPACT_EVERY`` of them are read.
        """
        base = max([b for b in self._numbers("base") if b < batch], default=None)
        since = [b for b in self._numbers("batch") if (base is None or b > base) and b <= batch]
        names = [f"batch-{b}" for b in since] + ([] if base is None else [f"base-{base}"])
        return add_partials(self._read(names))

    def compact(self, batch: int) -> None:
        """After every ``COMPACT_EVERY``-th batch: write a base and remove what two bases make useless."""
        if (batch + 1) % self.compact_every:
            return
        self.upto(batch).write.mode("overwrite").parquet(f"{self.root}/base-{batch}")
        earlier = [b for b in self._numbers("base") if b < batch]
        if earlier:
            for b in self._numbers("batch"):
                if b <= earlier[-1]:
                    remove(self.spark, f"{self.root}/batch-{b}")
            for b in earlier[:-1]:
                remove(self.spark, f"{self.root}/base-{b}")


def apply_batch(rows: DataFrame, batch: int, ledger: DailyLedger, weather: DataFrame,
                generation_path: str, weather_path: str, n: int = ROLLING_ROWS,
                partition_col: str = "date") -> None:
    """Record one batch and put the days it touches into both daily tables; replays change nothing."""
    changed = ledger.record(rows, batch).select("country_code", "date").distinct()
    with Staging(ledger.spark) as staging:
        changed = staging.put(changed)
        days = touched_days(changed)
        if days:
            sums = ledger.upto(batch).where(F.col("date").isin(days))
            rollup = staging.put(rollup_of(matching(sums, changed, ["country_code", "date"])))
            put_changed(ledger.spark, staging, rollup, weather, generation_path, weather_path, n, partition_col)
    ledger.compact(batch)


def refresh_stream(spark: SparkSession, landing: str, weather: DataFrame, generation_path: str, weather_path: str,
                   ledger_path: str, checkpoint: str, files_per_batch: int | None = None, n: int = ROLLING_ROWS,
                   partition_col: str = "date", schema=schemas.GENERATION_RAW, compact_every: int = COMPACT_EVERY,
                   **partial_params) -> int:
    """Read all files landed since the last run and refresh both daily tables; returns the number of batches.

    ``landing`` is a folder of hourly Parquet files that only grows; a file is
    read once. Rows without a time belong to no day and are left out. ``files_per_batch`` bounds a batch. ``checkpoint``, the ledger and
    both tables belong together. Weather rows are taken as they are at the time
    of the batch, like a lookback refresh takes them.
    """
    source = spark.readStream.schema(schema)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    done: list[int] = []

    def put(rows: DataFrame, batch: int) -> None:
        own = rows.sparkSession
        stream = own.sparkContext.getLocalProperty("sql.streaming.queryId")
        ledger = DailyLedger(own, ledger_path, stream, compact_every, **partial_params)
        apply_batch(rows, batch, ledger, weather, generation_path, weather_path, n, partition_col)
        done.append(batch)

    query = (source.parquet(landing).writeStream.foreachBatch(put)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return len(done)
