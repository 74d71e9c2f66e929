"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled (by a keyed digest of their id) into a stream of
words, which is cut into blocks of equal length. Slot k of the schedule maps the point
frac(k * golden ratio) through the cumulative weights to a source; the slots of a source
are ranked, and slot r takes block r mod (number of blocks). A document's take is the sum
of its overlaps with the blocks that were taken.

Ranks and running sums over a source are found in two steps, by keyed sub-ranges of
bounded size and within them, so that no source passes through one task whole. The same
holds for the sources themselves, which may be as many as hosts: they are numbered, given
targets and laid out along the points as a table, and only totals reach the driver.

Null texts and texts without words have size 0 and take 0. Null sources form one source,
last in order. Documents with equal ids (or null ids) are ordered by a digest of their
text; equal rows are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Workspace

#: Steps of the integer golden-ratio sequence: k * STEP mod MODULUS (both fixed values).
MODULUS, STEP = 2147483647, 1327217885
CHUNK, BINS, SOURCES = 4096, 65536, 100_000


def targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """Shares 100 % of all sizes by weight; a source gets ``most`` times its size at most,
    and what is over goes to the others by weight, until none is above. The rule on plain
    lists, which ``plan_sources`` follows on tables (tests hold one against the other)."""
    total, out, free = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    rest = total
    while free:
        all_weight = sum(weights[i] for i in sorted(free))
        over = [i for i in sorted(free) if rest * weights[i] / all_weight > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = rest * weights[i] / all_weight
            break
        for i in over:
            out[i] = most * sizes[i]
            free.discard(i)
        rest = total - sum(out[i] for i in range(len(sizes)) if i not in free)
    return out


def running(ws: Workspace, df: DataFrame, key: str, order: list[str], part: str, value: str, out: str, rows: int | None = None) -> DataFrame:
    """Adds the sum of ``value`` over earlier rows of ``key`` in (part, order) order.

    ``part`` numbers sub-ranges of bounded size; sums of sub-ranges come first."""
    sums = df.groupBy(key, part).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = ws.table(sums.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum"), "sums", rows)
    inner = Window.partitionBy(key, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = df.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return within.join(base, [key, part]).withColumn(out, F.col("_base") + F.col("_in")).drop("_base", "_in")


def plan_sources(ws: Workspace, per: DataFrame, weights: tuple[float, ...], block: int, most: float, n_rows: int | None = None) -> tuple[DataFrame, int]:
    """(a row per source of (source, size, n) with its number, target, blocks and range of
    points; the number of slots). Numbers follow code points, null last."""
    # a sorted table is written partition by partition, so a number is the rows of the
    # partitions before and the place in the own one
    order = [F.col("source").isNull(), F.col("source")]
    per = ws.table(per, "per-source", n_rows)
    k = per.count()
    # few enough sources are sorted by one task; numbers need no more than the order
    rows = per.orderBy(*order) if k > SOURCES else per.coalesce(1).sortWithinPartitions(*order)
    rows = ws.table(rows.withColumn("file", F.spark_partition_id()), "sources")
    ahead, first = 0, {}
    for r in sorted(rows.groupBy("file").count().collect()):  # a row per partition
        first[r["file"]], ahead = ahead, ahead + r["count"]
    offsets = ws.spark.createDataFrame(list(first.items()), "file int, ahead long")
    rows = rows.join(F.broadcast(offsets), "file").withColumn("source_no", (F.col("ahead") + F.row_number().over(Window.partitionBy("file").orderBy(*order)) - 1).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("source_no") % len(weights) + 1)
    rows = ws.table(rows.select("source_no", "source", F.col("size").alias("source_size"), "n", weight.alias("weight")), "numbered", k)
    total = float(rows.agg(F.sum("source_size")).first()[0] or 0)
    # a source is capped once its share of what is left is above; each round may cap more
    share, capped = None, -1
    while True:
        over = F.lit(False) if share is None else F.lit(share) * F.col("weight") > most * F.col("source_size")
        r = rows.agg(F.count_if(over).alias("k"), F.sum(F.when(over, most * F.col("source_size"))).alias("taken"), F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        if r["k"] == capped:
            break
        capped, left, free = r["k"], total - (r["taken"] or 0.0), r["weight"]
        if not free:
            break
        share = left / free
    over = F.lit(share or 0.0) * F.col("weight") > most * F.col("source_size")
    target = F.when(over, most * F.col("source_size")).otherwise(F.lit(left) * F.col("weight") / F.lit(free or 1.0))
    blocks = F.when(F.col("source_size") > 0, F.greatest(F.lit(1), F.expr(f"(2 * source_size + {block}) div {2 * block}"))).otherwise(0)
    rows = rows.withColumn("target", target.cast("double")).withColumn("blocks", blocks.cast("long"))
    # slots of each source in millionths, so that bounds are exact whole numbers
    slots = F.when(F.col("source_size") > 0, F.floor(F.col("target") * F.col("blocks") / F.col("source_size") * 1e6)).otherwise(0).cast("long")
    rows = rows.withColumn("slots", slots).withColumn("all", F.lit(0)).withColumn("part", F.floor(F.col("source_no") / CHUNK).cast("long"))
    rows = ws.table(running(ws, rows, "all", ["source_no"], "part", "slots", "at", k), "laid-out", k)
    n = int(rows.agg(F.sum(F.col("slots").cast("decimal(38,0)"))).first()[0] or 0)
    bound = lambda c: F.expr(f"cast({c} AS decimal(27,0)) * {MODULUS} div {max(1, n)}").cast("long")
    rows = rows.select("source_no", "source", "source_size", "target", "blocks", bound("at").alias("low"), bound("at + slots").alias("high"), F.greatest(F.lit(1), F.expr(f"n div {CHUNK}")).cast("long").alias("parts"))
    return ws.table(rows, "plan", k), (n + 500_000) // 1_000_000


def schedule(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), block: int = 128, seed: str = "mix", most: float = 3.0, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents with their take, slots): the slots are (slot, source_no, block). A column
    ``key`` that tells rows apart is handed on."""
    own = [key] if key else []
    spark, ws = docs.sparkSession, Workspace(docs.sparkSession, "schedule")
    rows = docs.select(*own, "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit("")))).alias("place"), F.md5(F.coalesce("text", F.lit(""))).alias("tie"))
    rows = ws.table(rows, "sizes")
    per = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    n = rows.count()
    plan, n_slots = plan_sources(ws, per, weights, block, most, n)
    # one row per source: adaptive execution checks the size before it broadcasts
    docs_in = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(*own, "doc_id", "size", "place", "tie", plan["source_no"], "source_size", "target", "blocks", "parts")
    docs_in = docs_in.withColumn("part", F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * F.col("parts") / F.lit(1 << 32)).cast("long"))
    placed = ws.table(running(ws, docs_in, "source_no", ["place", "tie"], "part", "size", "start", n).withColumn("row", F.monotonically_increasing_id()), "placed", n)
    ids = spark.range(n_slots).select(F.col("id").alias("slot"), (F.col("id") % MODULUS * STEP % MODULUS).alias("point"), F.floor(F.col("id") / CHUNK).cast("long").alias("part"))
    # a slot's source: points meet ranges by the bin both fall in, of which a source has some
    # and all sources together at most BINS more than there are sources
    ranges = plan.filter("blocks > 0 AND high > low").select("source_no", "low", "high", "blocks")
    width = -(-MODULUS // BINS)
    ranges = ranges.withColumn("bin", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
    hit = ids.withColumn("bin", F.floor(F.col("point") / width)).join(ranges, "bin").filter("point >= low AND point < high").drop("bin").withColumn("one", F.lit(1))
    hit = ws.table(hit, "points", n_slots)
    ranked = running(ws, hit, "source_no", ["slot"], "part", "one", "rank", n_slots).filter(F.col("rank") < F.col("blocks") * F.lit(int(most)))
    taken = ws.table(ranked.select("slot", "source_no", (F.col("rank") % F.col("blocks")).alias("block")), "slots", n_slots)
    times = taken.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    # block b holds the words [b * size div blocks, (b + 1) * size div blocks) of its source's stream
    first = F.expr("greatest(start * blocks div source_size - 1, 0)")
    last = F.expr("least((start + size - 1) * blocks div source_size + 1, blocks - 1)")
    pieces = placed.filter("size > 0").select("row", "source_no", "start", "size", "source_size", "blocks", F.explode(F.sequence(first, last)).alias("block"))
    pieces = pieces.withColumn("words", F.expr("least(start + size, (block + 1) * source_size div blocks) - greatest(start, block * source_size div blocks)")).filter("words > 0")
    takes = pieces.select("row", "source_no", "block", "words").join(times, ["source_no", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = placed.join(takes, "row", "left").select(*own, "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source_no", "start")
    return out, taken
