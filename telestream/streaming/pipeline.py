"""The read side as Structured Streaming: delivery, idempotent sinks, lease observation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery



def deliver(records: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Delivers every available record at least once; the offset log moves after the sink."""
    writer = records.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def idempotent_sink(path: str, ids: tuple[str, ...] = ("shard_id", "seq")) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch to a folder named by its number, so that a repeated batch
    replaces what its first attempt wrote."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(list(ids)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def outcome_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Outcome counts of each micro-batch, by shard."""

    def write(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy("shard_id", "outcome").agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def event_stream(spark: SparkSession, sf_dir: str, per_trigger: int = 1) -> DataFrame:
    """The events table as a file stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", per_trigger).parquet(f"{sf_dir}/events.parquet*")


def observe(leases: DataFrame) -> DataFrame:
    """(shard_id, counter, seen_at, passes) of a stream of (shard_id, counter, at): when a
    lease's counter was last seen to move, and for how many rows it has stood still."""
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class Observe(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("lease", "counter long, seen_at long, passes long")

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            import pandas as pd

            now = self.state.get() if self.state.exists() else None
            for frame in rows:
                for counter, at in sorted(zip(frame["counter"], frame["at"]), key=lambda x: x[1]):
                    now = (int(now[0]), int(now[1]), int(now[2]) + 1) if now and now[0] == counter else (int(counter), int(at), 1)
            self.state.update(now)
            yield pd.DataFrame({"shard_id": [key[0]], "counter": [now[0]], "seen_at": [now[1]], "passes": [now[2]]})

        def close(self) -> None:
            pass

    return leases.groupBy("shard_id").transformWithStateInPandas(Observe(), "shard_id string, counter long, seen_at long, passes long", "Update", "None")
