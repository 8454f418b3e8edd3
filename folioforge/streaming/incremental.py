"""Incremental runs as file streams: what has landed is processed once, results are upserted by key.

The checkpoint takes the place of "skip what already has an output"; an empty read is not done and comes again with its file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.sources import sinks


def process_new(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, keys: list[str], transform: Callable[[DataFrame], DataFrame], fmt: str = "parquet"
) -> None:
    """Everything new under ``source`` through ``transform`` into the table at ``target``, then stop."""

    def batch(df: DataFrame, _: int) -> None:
        sinks.upsert(transform(df), target, keys)

    stream = spark.readStream.schema(schema).format(fmt).load(source)
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def carry_stream(lines: DataFrame, late: str = "1 hour") -> DataFrame:
    """Surname carry over a stream of lines (volume, ts, surname or null): valid only where lines arrive in order.

    State is the last surname of each volume; by default records are parsed in batch for a whole volume instead.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key, batches, state):
        last = state.get[0] if state.exists else ""
        for pdf in batches:
            rows = pdf.sort_values("ts")
            known = rows["surname"].where(rows["surname"].notna())
            filled = known.ffill().fillna(last)
            last = filled.iloc[-1] if len(filled) else last
            yield pd.DataFrame({"volume": key[0], "ts": rows["ts"], "surname": filled})
        state.update((last,))

    return (
        lines.withWatermark("ts", late)
        .groupBy("volume")
        .applyInPandasWithState(step, "volume string, ts timestamp, surname string", "last string", "append", GroupStateTimeout.NoTimeout)
    )


def windowed_counts(events: DataFrame, time: str = "ts", every: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Events of each type by window, final once the watermark has passed."""
    return events.withWatermark(time, late).groupBy(F.window(time, every), "event_type").agg(F.count(F.lit(1)).alias("n"))
