"""Record outcomes, prefix checkpoints, stuck passes, dead letters, delivery audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.outcomes import RETRY
from ..functions.text import base64_line

DEAD_LETTER = "kinesis.dead_letter"


def checkpoint_prefix(records: DataFrame, page: list[str], seq: str = "seq") -> DataFrame:
    """(page, checkpoint, stuck): the last sequence before the first Retry of each page.

    Two partial aggregates over (page, sequence) replace a window, so that a long shard
    is never sorted in one task.
    """
    first = F.min(F.when(F.col("outcome") == RETRY, F.col(seq)))
    stops = records.groupBy(*page).agg(first.alias("_stop"))
    good = records.join(stops, page).filter(F.col("_stop").isNull() | (F.col(seq) < F.col("_stop")))
    last = good.groupBy(*page).agg(F.max(seq).alias("checkpoint"))
    return stops.join(last, page, "left").select(*page, "checkpoint", (F.col("checkpoint").isNull() & F.col("_stop").isNotNull()).alias("stuck"))


def stuck_runs(passes: DataFrame, shard: str, order: str, stuck: str) -> DataFrame:
    """(shard, passes, longest): the longest run of passes without progress of each shard."""
    w = Window.partitionBy(shard).orderBy(order)
    island = F.sum(F.when(F.col(stuck), 0).otherwise(1)).over(w)
    runs = passes.withColumn("_run", island).groupBy(shard, "_run").agg(F.count_if(F.col(stuck)).alias("n"), F.count("*").alias("k"))
    return runs.groupBy(shard).agg(F.sum("k").alias("passes"), F.max("n").alias("longest"))


def dead_letter_attrs(encoding: str, codec: str) -> Column:
    """The six attributes of a wrapped record."""
    values = {"kinesis.raw": base64_line(F.col("data")), "kinesis.sequence": F.col("seq").cast("string"), "kinesis.partition_key": F.col("partition_key"), "kinesis.failure_class": F.col("failure_class"), "kinesis.encoding": F.lit(encoding), "kinesis.codec": F.lit(codec)}
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])


def dead_letters(records: DataFrame, signal: str, encoding: str, codec: str, enabled: bool = True) -> DataFrame:
    """Records that could not be unpacked or decoded, as items of ``signal``."""
    wrapped = records.filter(F.col("failure_class").isNotNull() & F.lit(enabled)).select("shard_id", "seq", dead_letter_attrs(encoding, codec).alias("attrs"))
    if signal == "traces":
        return wrapped.withColumn("name", F.lit(DEAD_LETTER))
    if signal == "metrics":
        return wrapped.withColumns({"metric": F.lit(DEAD_LETTER), "kind": F.lit("gauge"), "int_value": F.lit(1).cast("long")})
    if signal == "logs":
        return wrapped.withColumn("body", F.lit(DEAD_LETTER))
    raise ValueError(f"unknown signal {signal!r}")


def dup_tolerance(expected: Column) -> Column:
    return F.greatest(F.lit(5).cast("long"), F.floor(expected / 10).cast("long"))


def audit(expected: DataFrame, delivered: DataFrame, ids: list[str]) -> DataFrame:
    """(expected, delivered, unique, loss, dupes, tolerance, within): at-least-once figures."""
    want = expected.select(*ids).distinct()
    counts = delivered.groupBy(*ids).agg(F.count("*").alias("n"))
    both = want.join(counts, ids, "left")
    out = both.agg(F.count("*").alias("expected"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("delivered"), F.count("n").alias("unique_ids"))
    loss, dupes = F.col("expected") - F.col("unique_ids"), F.col("delivered") - F.col("unique_ids")
    return out.select("expected", "delivered", "unique_ids", loss.alias("loss"), dupes.alias("dupes"), dup_tolerance(F.col("expected")).alias("tolerance"), ((loss == 0) & (dupes <= dup_tolerance(F.col("expected")))).alias("within"))
