"""Benchmark reports: line parsing, nearest-rank percentiles, pivots, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import show_bytes, show_ns, show_per_record, show_ratio

#: The result line of a benchmark, as the report reads it (a fixed format).
HEAD = r"^\s*Benchmark(Encode|Decode)(Metrics|Traces)/([^/]+)/([^/]+)/([^/]+)/n=(\d+)-\d+"
RESULT = HEAD + r"\s+(\d+)\s+([\d.]+) ns/op"
#: Orders in which the tables list codecs and encodings (fixed values).
CODEC_ORDER = ["none", "gzip", "zstd", "snappy", "x-snappy-framed", "zlib", "deflate"]
ENCODING_ORDER = ["otlp_proto", "otlp_json"]
METRICS = ["compressed_bytes", "compression_ratio", "compressed_bytes_per_record", "min_ns", "p50_ns", "p90_ns", "max_ns", "samples", "B/op", "allocs/op"]


def metric(line: Column, name: str) -> Column:
    found = F.regexp_extract(line, rf"([\d.eE+-]+)\s+{name}\b", 1)
    return F.when(found != "", found.cast("double"))


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Result rows and, with ``skipped``, rows of runs that have no result; others go."""
    line = F.col(column)
    part = lambda i: F.regexp_extract(line, HEAD, i)
    done = line.rlike(RESULT)
    rows = lines.filter(done | line.rlike(HEAD + r"\s*$"))
    named = {m.replace("/", "_"): F.when(done, metric(line, m)) for m in METRICS}
    return rows.select(part(1).alias("kind"), F.lower(part(2)).alias("signal"), part(3).alias("profile"), part(4).alias("enc"), part(5).alias("codec"), part(6).cast("long").alias("n"), F.when(done, F.regexp_extract(line, RESULT, 8).cast("double")).alias("ns"), *[c.alias(k) for k, c in named.items()], (~done).alias("skipped"))


def nearest_rank(value: str, fraction: float) -> Column:
    """sorted[int(fraction * (n - 1))] of a group; 0 if it is empty.

    The group's values are gathered: for reports. ``rank_table`` does it for large groups.
    """
    xs = F.sort_array(F.collect_list(value))
    at = F.floor(F.lit(fraction) * (F.size(xs) - 1)).cast("int") + 1
    return F.coalesce(F.try_element_at(xs, F.when(F.size(xs) > 0, at).otherwise(1)), F.lit(0.0))


def rank_table(df: DataFrame, by: Sequence[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles of groups of any size.

    Equal values are counted first (a partial aggregate), and running totals over the
    distinct values give the one that holds each rank.
    """
    from pyspark.sql import Window

    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by).orderBy(value)
    upto = counts.withColumn("_upto", F.sum("_n").over(w)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*by)))
    rank = lambda f: F.floor(F.lit(f) * (F.col("_all") - 1)) + 1
    hit = lambda f: F.min(F.when(F.col("_upto") >= rank(f), F.col(value)))
    return upto.groupBy(*by).agg(F.min(value).alias("min"), *[hit(f).alias(k) for k, f in fractions.items()], F.max(value).alias("max"), F.sum("_n").alias("samples"))


def summary(rows: DataFrame, kind: str, signal: str, profile: str) -> DataFrame:
    """One row per codec and batch size, with p50, p90, bytes per record, total and, for
    encoding, ratio under each encoding; a dash where there is no result."""
    own = rows.filter((F.col("kind") == kind) & (F.col("signal") == signal) & (F.col("profile") == profile))
    shown = {"p50": show_ns(F.col("p50_ns")), "p90": show_ns(F.col("p90_ns")), "per_record": show_per_record(F.col("compressed_bytes_per_record")), "total": show_bytes(F.col("compressed_bytes"))}
    if kind == "Encode":
        shown["ratio"] = show_ratio(F.col("compression_ratio"))
    cells = own.select("codec", "n", "enc", *[F.when(F.col("skipped"), "—").otherwise(c).alias(k) for k, c in shown.items()])
    wide = cells.groupBy("codec", "n").pivot("enc", ENCODING_ORDER).agg(*[F.last(k).alias(k) for k in shown])
    place = F.array_position(F.array(*map(F.lit, CODEC_ORDER)), F.col("codec"))
    return wide.na.fill("—").filter(place > 0).orderBy(place, "n")


def details(rows: DataFrame, kind: str, signal: str, profile: str) -> DataFrame:
    """(codec, n, details): a line per encoding."""
    own = rows.filter((F.col("kind") == kind) & (F.col("signal") == signal) & (F.col("profile") == profile))
    text = F.when(F.col("skipped"), F.concat("enc", F.lit(": —"))).otherwise(F.concat("enc", F.lit(": mean "), show_ns(F.col("ns")), F.lit(" · min "), show_ns(F.col("min_ns")), F.lit(" · max "), show_ns(F.col("max_ns")), F.lit(" · "), F.coalesce(F.col("samples"), F.lit(0)).cast("long").cast("string"), F.lit(" samples · "), show_bytes(F.col("B_op")), F.lit(" alloc · "), F.coalesce(F.col("allocs_op"), F.lit(0)).cast("long").cast("string"), F.lit(" allocs")))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.array_position(F.array(*map(F.lit, ENCODING_ORDER)), F.col("enc"))).alias("p"), text.alias("t"))), asc=False), lambda x: x["t"]), "\n")
    return own.groupBy("codec", "n").agg(listed.alias("details"))


def ratios(raw: Column, packed: Column, n: Column) -> dict[str, Column]:
    """compression_ratio and bytes per record, 0 where there is nothing to divide by."""
    over = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return {"compression_ratio": over(raw, packed), "compressed_bytes_per_record": over(packed, n), "raw_bytes_per_record": over(raw, n)}


def histogram(value: Column, bounds: Sequence[float]) -> Column:
    """The index of the bucket (lower exclusive, upper inclusive) a value falls in."""
    return F.aggregate(F.array(*[F.lit(float(b)) for b in bounds]), F.lit(0), lambda n, b: n + F.when(value > b, 1).otherwise(0))
