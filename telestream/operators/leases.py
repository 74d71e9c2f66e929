"""Lease snapshots as tables: fair share, plans, gating, freshness, reaping, fenced writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SHARD_END, TRIM_HORIZON

REAP_AFTER = 3
CONFLICT, NOT_FOUND, DONE = "conflict", "not_found", "ok"


def active(leases: DataFrame) -> DataFrame:
    return leases.filter(F.coalesce(F.col("checkpoint"), F.lit("")) != SHARD_END)


def owned_by(worker: Column, owner: Column = None) -> Column:
    owner = F.col("owner") if owner is None else owner
    return (F.coalesce(owner, F.lit("")) != "") & (owner == worker)


def with_drained(leases: DataFrame) -> DataFrame:
    """Adds drained: every parent that has a lease is at its end; absent parents count."""
    ends = leases.select(F.col("shard_id").alias("_p"), (F.col("checkpoint") == SHARD_END).alias("_end"))
    asked = leases.select("shard_id", F.explode("parents").alias("_p")).join(ends, "_p")
    blocked = asked.filter(~F.col("_end")).select("shard_id").distinct().withColumn("_blocked", F.lit(True))
    return leases.join(blocked, "shard_id", "left").withColumn("drained", F.col("_blocked").isNull()).drop("_blocked")


def share(shards: Column, workers: Column) -> Column:
    """The fair share: shards over workers, rounded up."""
    return F.when(shards == 0, 0).otherwise(F.ceil(shards / F.greatest(workers, F.lit(1)))).cast("long")


def targets(leases: DataFrame, workers: DataFrame) -> DataFrame:
    """(self, shards, workers, target) for each row of ``workers`` (self): the share counts
    the owners with a fresh lease, and the worker itself."""
    live = active(leases)
    owners = live.filter((F.col("owner") != "") & F.col("fresh")).select("owner").distinct()
    # two totals: one row, whatever the tables hold
    totals = live.agg(F.count("*").alias("shards")).crossJoin(owners.agg(F.count("*").alias("_owners")))
    found = workers.select("self").join(owners.select(F.col("owner").alias("self"), F.lit(1).alias("_in")), "self", "left").crossJoin(totals)
    n = F.col("_owners") + F.when(F.col("_in").isNull(), 1).otherwise(0)
    return found.select("self", "shards", n.cast("long").alias("workers"), share(F.col("shards"), n).alias("target"))


def steal_targets(leases: DataFrame, goal: DataFrame) -> DataFrame:
    """(self, owner, shard_id): the lowest drained shard of the peer that holds most above
    target, ties to the lowest owner; null where that peer has no drained shard."""
    held = active(leases).filter((F.col("owner") != "") & F.col("fresh"))
    peers = held.groupBy("owner").agg(F.count("*").alias("n"), F.min(F.when(F.col("drained"), F.col("shard_id"))).alias("shard_id"))
    # whoever a worker is, its fullest peer is one of the first two: two rows
    two = peers.orderBy(F.desc("n"), "owner").limit(2)
    over = goal.crossJoin(two).filter((F.col("owner") != F.col("self")) & (F.col("n") > F.col("target")))
    best = over.groupBy("self").agg(F.min(F.struct((-F.col("n")).alias("n"), "owner", "shard_id")).alias("b"))
    return best.select("self", "b.owner", "b.shard_id")


def plan_actions(leases: DataFrame, workers: DataFrame) -> DataFrame:
    """(self, action, shard_id) of every worker over one snapshot, read in shard order.

    A worker above its target releases the highest shards; one below it acquires drained
    shards that are free, stale or its own, up to its target, and steals one if it is
    still short. Shards are ranked once, among those of their owner and among the free ones,
    and workers meet them by owner and by rank, so that no worker meets every shard."""
    goal = targets(leases, workers)
    rows = active(leases)
    mine = rows.filter("owner <> ''").select(F.col("owner").alias("self"), "shard_id", F.row_number().over(Window.partitionBy("owner").orderBy("shard_id")).alias("place"))
    held = mine.groupBy("self").agg(F.count("*").alias("held"))
    # free for all but their owner: stale ones are still theirs
    free = rows.filter(F.col("drained") & ((F.col("owner") == "") | ~F.col("fresh")))
    free = free.select("owner", "shard_id", F.row_number().over(Window.orderBy("shard_id")).alias("place"))
    stale = free.filter("owner <> ''").groupBy(F.col("owner").alias("self")).agg(F.count("*").alias("stale"))
    count = free.agg(F.count("*").alias("free"))
    wants = goal.join(held, "self", "left").join(stale, "self", "left").crossJoin(count).na.fill(0, ["held", "stale"])
    wants = wants.withColumn("want", F.col("target") - F.col("held"))
    release = mine.join(wants, "self").filter((F.col("held") > F.col("target")) & (F.col("place") > F.col("target"))).select("self", "shard_id")
    # the first that a worker may take are among the first ``want`` and its own stale ones
    reach = F.least(F.col("want") + F.col("stale"), F.col("free"))
    asked = wants.filter("want > 0 AND free > 0").select("self", "want", F.explode(F.sequence(F.lit(1).cast("long"), reach)).alias("place"))
    taken = asked.join(free.withColumn("place", F.col("place").cast("long")), "place").filter("owner <> self")
    taken = taken.withColumn("turn", F.row_number().over(Window.partitionBy("self").orderBy("place"))).filter("turn <= want")
    moves = release.select("self", F.lit("release").alias("action"), "shard_id").unionByName(taken.select("self", F.lit("acquire").alias("action"), "shard_id"))
    short = wants.filter("want - (free - stale) > 0").select("self")
    steal = steal_targets(leases, goal).join(short, "self").filter("shard_id IS NOT NULL")
    return moves.unionByName(steal.select("self", F.lit("steal").alias("action"), "shard_id"))


def discover(shards: DataFrame, leases: DataFrame) -> DataFrame:
    """Lease rows to insert: listed shards (shard_id, parents) that have none yet."""
    new = shards.join(leases.select("shard_id"), "shard_id", "left_anti")
    return new.select("shard_id", F.lit("").alias("owner"), F.lit(0).cast("long").alias("counter"), F.lit(TRIM_HORIZON).alias("checkpoint"), "parents")


def refresh(leases: DataFrame, observed: DataFrame, now: int) -> DataFrame:
    """(shard_id, counter, seen_at): stamps leases that are new or moved; vanished ones go."""
    old = observed.select("shard_id", F.col("counter").alias("_c"), F.col("seen_at").alias("_t"))
    seen = F.when(F.col("_c").eqNullSafe(F.col("counter")), F.col("_t")).otherwise(F.lit(now))
    return leases.join(old, "shard_id", "left").select("shard_id", "counter", seen.alias("seen_at"))


def fresh(owner: Column, seen_at: Column, now: Column, duration: int) -> Column:
    return (F.coalesce(owner, F.lit("")) != "") & seen_at.isNotNull() & (now - seen_at < duration)


def reaped(passes: DataFrame, after: int = REAP_AFTER) -> DataFrame:
    """(shard_id, first pass at which its lease may go) from (pass, shard_id, listed, ended,
    busy): absent for ``after`` passes in a row, at its end and not in use. Reappearing
    starts the count again; a pass that lists nothing is skipped."""
    listed = passes.groupBy("pass").agg(F.max("listed").alias("any")).filter("any").select("pass")
    rows = passes.join(listed, "pass").filter(F.col("listed") | F.col("ended"))
    w = Window.partitionBy("shard_id").orderBy("pass")
    rows = rows.withColumn("run", F.sum(F.col("listed").cast("int")).over(w))
    rows = rows.withColumn("absent", F.sum((~F.col("listed")).cast("int")).over(Window.partitionBy("shard_id", "run").orderBy("pass")))
    return rows.filter(~F.col("listed") & ~F.col("busy") & (F.col("absent") >= after)).groupBy("shard_id").agg(F.min("pass").alias("pass"))


def _state(exists, owner, counter, checkpoint, ok, conflict, missing) -> Column:
    return F.struct(exists.alias("exists"), owner.alias("owner"), counter.cast("long").alias("counter"), checkpoint.alias("checkpoint"), ok.cast("long").alias("ok"), conflict.cast("long").alias("conflicts"), missing.cast("long").alias("missing"))


def apply_writes(ops: DataFrame, shard: str, order: str) -> DataFrame:
    """Folds fenced writes (kind, owner, expected, seq) of each shard in order.

    ``expected`` is the counter that the writer saw; only the counter as it is passes the
    fence. ensure creates; acquire needs the counter; heartbeat, checkpoint and release need
    owner and counter; delete needs the counter and forgives an absent lease. A write that
    fails leaves the lease as it was. Counted are writes that took effect, conflicts, and
    writes to a lease that is not there. The state of the fold is one lease, and a shard's
    history is a row: cut histories by time, or fold them with ``observe`` as they arrive,
    where they have no end.
    """
    item = F.struct(F.col(order).alias("o"), "kind", "owner", "expected", "seq")
    rows = ops.groupBy(shard).agg(F.sort_array(F.collect_list(item)).alias("ops"))
    none = _state(F.lit(False), F.lit(""), F.lit(0), F.lit(TRIM_HORIZON), F.lit(0), F.lit(0), F.lit(0))

    def step(s: Column, x: Column) -> Column:
        kind = x["kind"]
        fence = (x["expected"] == s["counter"]) & (kind.isin("acquire", "delete") | (s["owner"] == x["owner"]))
        keep = _state(s["exists"], s["owner"], s["counter"], s["checkpoint"], s["ok"], s["conflicts"], s["missing"])
        made = _state(F.lit(True), F.lit(""), F.lit(0), F.lit(TRIM_HORIZON), s["ok"] + 1, s["conflicts"], s["missing"])
        gone = _state(F.lit(False), F.lit(""), F.lit(0), F.lit(TRIM_HORIZON), s["ok"] + 1, s["conflicts"], s["missing"])
        lost = _state(s["exists"], s["owner"], s["counter"], s["checkpoint"], s["ok"], s["conflicts"] + 1, s["missing"])
        absent = _state(s["exists"], s["owner"], s["counter"], s["checkpoint"], s["ok"], s["conflicts"], s["missing"] + 1)
        owner = F.when(kind == "acquire", x["owner"]).when(kind == "release", "").otherwise(s["owner"])
        point = F.when(kind == "checkpoint", x["seq"]).otherwise(s["checkpoint"])
        done = _state(F.lit(True), owner, s["counter"] + 1, point, s["ok"] + 1, s["conflicts"], s["missing"])
        return (
            F.when((kind == "ensure") & s["exists"], keep)
            .when(kind == "ensure", made)
            .when(~s["exists"] & (kind == "delete"), keep)
            .when(~s["exists"], absent)
            .when(~fence, lost)
            .when(kind == "delete", gone)
            .otherwise(done)
        )

    return rows.select(shard, F.aggregate("ops", none, step).alias("s")).select(shard, "s.*")


def marshal(leases: DataFrame) -> DataFrame:
    """The stored form: empty owners and parents are left out, parents joined by commas."""
    parents = F.when(F.size("parents") > 0, F.array_join("parents", ","))
    return leases.select(F.col("shard_id").alias("leaseKey"), F.nullif("owner", F.lit("")).alias("leaseOwner"), F.col("counter").cast("string").alias("leaseCounter"), "checkpoint", parents.alias("parentShardId"))


def unmarshal(rows: DataFrame) -> DataFrame:
    """Lease rows; the key is mandatory and a counter that is no number is an error."""
    key = F.when(F.coalesce(F.col("leaseKey"), F.lit("")) == "", F.raise_error(F.lit("a lease row has no leaseKey")).cast("string")).otherwise(F.col("leaseKey"))
    parents = F.when(F.coalesce(F.col("parentShardId"), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split("parentShardId", ","))
    return rows.select(key.alias("shard_id"), F.coalesce("leaseOwner", F.lit("")).alias("owner"), F.coalesce(F.col("leaseCounter").cast("long"), F.lit(0)).alias("counter"), F.coalesce("checkpoint", F.lit("")).alias("checkpoint"), parents.alias("parents"))


def ownership(leases: DataFrame) -> DataFrame:
    """One row: owned, total, owners, signature ``owner=n;``..., balanced."""
    per = leases.filter(F.coalesce(F.col("owner"), F.lit("")) != "").groupBy("owner").agg(F.count("*").alias("n"))
    spread = F.max("n") - F.min("n") <= 1
    parts = F.sort_array(F.collect_list(F.struct("owner", "n")))
    text = F.array_join(F.transform(parts, lambda p: F.concat(p["owner"], F.lit("="), p["n"].cast("string"), F.lit(";"))), "")
    found = per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("owned"), F.count("*").alias("owners"), text.alias("signature"), F.coalesce(spread, F.lit(False)).alias("balanced"))
    return found.crossJoin(leases.agg(F.count("*").alias("total"))).select("owned", "total", "owners", "signature", "balanced")
