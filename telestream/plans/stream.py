"""Queries over sending, delivery, checkpoints, leases."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from ..config import ReaderConfig
from ..functions import outcomes
from ..operators import delivery, leases, sending
from ..packaging import shared_dir, ship
from ..schema import RECORD, SHARD_END, TRIM_HORIZON, table
from ..schema import leases as lease_rows
from ..sources import codecs, shards
from ..streaming import receiver, stores
from . import batches

PAGE = 50
#: Pages of a shard that a replica takes in a pass, and events to a file of its stream.
AHEAD, EVENTS_A_FILE = 200, 50_000
#: How the records of the events are read.
READER = ReaderConfig(stream_name="events", region="local", encoding="otlp_json", compression="zstd", dead_letter=True, worker_id="w0")


def chunk_requests(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", (F.octet_length("o_orderpriority") * 3).alias("bytes"))
    return sending.chunk_requests(o, "o_custkey", "o_orderkey", "bytes", 3, 60)


def retry_transient(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    fails = F.when(F.col("id") % 11 == 0, F.col("id") % 3 + 1).otherwise(F.col("id") % 7)
    answers = o.withColumn("fails", fails).filter("fails > 0").select("id", "fails", F.explode(F.sequence(F.lit(1), F.col("fails").cast("int"))).alias("attempt"))
    code = F.when((F.col("id") % 11 == 0) & (F.col("attempt") == F.col("fails")), "AccessDenied").when(F.col("id") % 2 == 0, outcomes.TRANSIENT[0]).otherwise(outcomes.TRANSIENT[1])
    found = sending.put_results(o, answers.select("id", "attempt", code.alias("code")), ["id"])
    return found.groupBy("result", "attempts").agg(F.count("*").alias("entries"))


def backoff_schedule(spark, d):
    return spark.range(21).select(F.col("id").alias("step"), outcomes.put_delay(F.col("id")).alias("put_ms"), outcomes.stuck_delay(F.col("id"), 250).alias("stuck_ms"))


def _read(spark, d):
    """The records of the events, unpacked, decoded and judged by what they hold."""
    return receiver.read_records(batches.event_records(spark, d).drop("error"), "logs", READER, batches.sink_verdict)


def record_outcomes(spark, d):
    x = _read(spark, d)
    return x.groupBy("shard_id", "outcome", F.coalesce("failure_class", F.lit("")).alias("failure_class")).agg(F.count("*").alias("records"))


def checkpoint_prefix(spark, d):
    """Pages of ``PAGE`` sequences of each shard: its checkpoint, and whether it is stuck."""
    x = _read(spark, d).withColumn("page", F.floor(F.col("seq") / PAGE).cast("long"))
    return delivery.checkpoint_prefix(x, ["shard_id", "page"])


def stuck_passes(spark, d):
    x = _read(spark, d).withColumn("page", F.floor(F.col("seq") / 8).cast("long"))
    pages = delivery.checkpoint_prefix(x, ["shard_id", "page"])
    return delivery.stuck_runs(pages, "shard_id", "page", "stuck")


def dead_letters(spark, d):
    """Dead letters with what they wrap: bytes that are no payload as they are, others unpacked."""
    x = delivery.dead_letters(_read(spark, d), "logs", READER.encoding, READER.compression)
    attrs = [F.col("attrs")[f"kinesis.{k}"].alias(k) for k in ("raw", "sequence", "partition_key", "failure_class", "encoding", "codec")]
    x = x.select("shard_id", "seq", "body", *attrs).withColumn("raw", F.unbase64("raw"))
    held = F.when(F.col("failure_class") == "decompress", F.col("raw")).otherwise(codecs.decompress(F.when(F.col("failure_class") != "decompress", F.col("raw")), READER.compression))
    return x.withColumn("held", F.decode(held, "utf-8")).drop("raw")


def delivery_audit(spark, d):
    """Records are delivered at least once: every 29th is delivered again."""
    x = _read(spark, d).select("shard_id", "seq", "outcome")
    again = x.filter("outcome = 'OK' AND seq % 29 = 0")
    return delivery.audit(x.select("shard_id", "seq"), x.select("shard_id", "seq").unionByName(again.select("shard_id", "seq")), ["shard_id", "seq"])


def _by_shard(records):
    """The records as a stream's files hold them: shard after shard, in the order of sequences."""
    return records.repartitionByRange("shard_id", "seq").sortWithinPartitions("shard_id", "seq")


def _shards(rows, parents):
    """Closed shards of (shard_id, last)."""
    return [receiver.Shard(r["shard_id"], parents.get(r["shard_id"], ()), r["last"]) for r in rows]


class _Counting(receiver.TableSink):
    """Rejects for now what it rejects on the first pass only: an error is let through once
    the record has been seen before."""

    def __init__(self, path):
        super().__init__(path)
        self.seen = 0

    def verdict(self, rows):
        self.seen += 1
        body = batches.sink_verdict(rows)
        return F.when((body != "transient") | F.lit(self.seen % 2 == 1), body)


def _drained(spark, d, replicas):
    """(store, replicas, folder) after replicas have read the events until every shard ended.
    The second shard is a child of the first, and waits for it. Events without a user are in no
    shard; those without a number cannot be read, but their shard is there."""
    folder = f"{shared_dir(spark)}/receiver-{uuid.uuid4().hex}"
    e = table(spark, d, "events").filter("user_id IS NOT NULL")
    shard = batches.shard_of(F.col("user_id"))
    last = e.groupBy(shard.alias("shard_id")).agg(F.coalesce(F.max("event_id"), F.lit(-1)).alias("last"), F.count("event_id").alias("n")).collect()  # a row per shard
    files = max(spark.sparkContext.defaultParallelism, -(-sum(r["n"] for r in last) // EVENTS_A_FILE))
    # dealt out as events, so that records are made once and not for finding the ranges as well
    e = e.filter("event_id IS NOT NULL").repartitionByRange(files, shard, "event_id").sortWithinPartitions(shard, "event_id")
    batches.records(e).drop("error").write.parquet(f"{folder}/stream")
    listed = _shards(last, {"shard-001": ("shard-000",)})
    stream, store = receiver.FolderStream(spark, f"{folder}/stream", lambda: listed), stores.MemoryStore()
    made = [receiver.Receiver(replace(READER, worker_id=f"w{k}"), spark, stream, store, _Counting(f"{folder}/{k}"), ahead=AHEAD) for k in range(replicas)]
    receiver.run(made, step=60_000)
    return store, made, folder


def read_loop(spark, d):
    """Two replicas drain the stream: what each shard's lease says, and what was delivered or
    set aside as a dead letter, each record counted once."""
    store, made, folder = _drained(spark, d, 2)
    ends = spark.createDataFrame([(x.shard_id, x.owner, x.checkpoint) for x in store.list()], "shard_id string, owner string, checkpoint string")
    delivered, dead = None, None
    for k in range(len(made)):
        a = spark.read.schema("shard_id string, seq long").parquet(f"{folder}/{k}/delivered")
        b = spark.read.schema("shard_id string, seq long").parquet(f"{folder}/{k}/dead")
        delivered, dead = (a, b) if delivered is None else (delivered.unionByName(a), dead.unionByName(b))
    n = delivered.distinct().groupBy("shard_id").agg(F.count("*").alias("delivered"))
    m = dead.distinct().groupBy("shard_id").agg(F.count("*").alias("dead"))
    return ends.join(n, "shard_id", "left").join(m, "shard_id", "left").na.fill(0)


def receiver_figures(spark, d):
    """What the counters of a replica that drains the stream alone come to."""
    _, made, _ = _drained(spark, d, 1)
    x = made[0].figures()
    kept = (F.col("name").isin("shards_owned") | F.col("event").isin("acquire", "release")).alias("kept")
    return x.filter(kept).select("name", "event", "result", "n")


def lease_reconcile(spark, d):
    """Replicas that join one after the other, each planning on its own: how the shards of the
    stream (nations under regions) are spread after each join has settled, and after one left."""
    rows = table(spark, d, "nation").select("n_nationkey").collect()  # the shards of a stream
    shards = [receiver.Shard(f"shard-{r['n_nationkey']:03d}") for r in rows]
    stream, store = receiver.TableStream(spark.createDataFrame([], RECORD), shards), stores.MemoryStore()
    made, out, now = [], [], 0
    for step, count in enumerate((1, 2, 3, 2)):
        if count > len(made):
            made.append(receiver.Receiver(replace(READER, worker_id=f"w{len(made)}"), spark, stream, store, receiver.TableSink("")).start(now))
        else:
            made.pop().shutdown(now)
        for _ in range(5):
            now += READER.heartbeat_interval
            for r in made:
                r.heartbeat(now)
                r.tick(now)
        held = [sum(x.owner == f"w{k}" for x in store.list()) for k in range(3)]
        out.append((step, count, sum(held), max(held), sum(len(r.held) for r in made)))
    return spark.createDataFrame(out, "step int, replicas int, owned int, most int, polled int")


def lease_store_history(spark, d):
    """A lease's life in a folder of conditional rows: what each write said, step by step."""
    store = stores.RowStore(stores.FolderRows(spark, f"{shared_dir(spark)}/leases-{uuid.uuid4().hex}"))
    said = []

    def step(name, call):
        try:
            got = call()
            said.append((len(said), name, "ok", got.counter if got else None))
            return got
        except (stores.LeaseConflict, stores.LeaseNotFound) as e:
            said.append((len(said), name, type(e).__name__, None))

    step("heartbeat", lambda: store.heartbeat(stores.Lease("a", "w1", 0)))
    step("ensure", lambda: store.ensure("a", ("p",)))
    step("ensure", lambda: store.ensure("a", ("q",)))
    one = step("acquire", lambda: store.acquire("a", "w1", 0))
    step("acquire", lambda: store.acquire("a", "w2", 0))
    two = step("checkpoint", lambda: store.checkpoint(one, "17"))
    step("heartbeat", lambda: store.heartbeat(one))
    three = step("heartbeat", lambda: store.heartbeat(two))
    step("delete", lambda: store.delete("a", 0))
    step("release", lambda: store.release(three))
    step("delete", lambda: store.delete("a", 4))
    step("delete", lambda: store.delete("a", 4))
    step("acquire", lambda: store.acquire("a", "w2", 4))
    return spark.createDataFrame(said, "step int, write string, answer string, counter long")


def _until_drained(restart, grow):
    """Restarts until a batch finds no rows, however many that takes; the stream grows after
    the second batch."""
    n = 0
    while restart() or n <= 2:
        if n == 1:
            grow()
        n += 1
    return n


def shard_stream_restarts(spark, d):
    """The shard source as a stream that is stopped after every batch, and gets a child shard
    on the way: each record once, the child after its parent."""
    ship(spark)
    shards.register(spark)
    root = f"{shared_dir(spark)}/restarts-{uuid.uuid4().hex}"
    e = table(spark, d, "events").select(F.format_string("shard-%03d", F.col("user_id") % 4).alias("shard_id"), (F.col("event_id") * 1000).alias("seq"), F.col("user_id").cast("string").alias("partition_key"), F.encode("props", "utf-8").alias("data"))
    _by_shard(e.filter("shard_id <> 'shard-003'")).write.mode("append").parquet(f"{root}/stream")
    total = e.count()
    limit = str(min(10_000, max(1, total // 12)))
    x = spark.readStream.format("shards").options(path=f"{root}/stream", maxRecords=limit, parents=json.dumps({"shard-003": ["shard-000"]}), checkpoint=f"{root}/offsets").load()

    def sink(batch, number):
        batch.select("shard_id", "seq", F.lit(number).cast("long").alias("number")).write.mode("overwrite").parquet(f"{root}/out/batch-{number}")

    def restart():
        q = x.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/offsets").trigger(once=True).start()
        q.awaitTermination()
        return q.lastProgress["numInputRows"] if q.lastProgress else 0

    _until_drained(restart, lambda: _by_shard(e.filter("shard_id = 'shard-003'")).write.mode("append").parquet(f"{root}/stream"))
    out = spark.read.schema("shard_id string, seq long, number long").parquet(f"{root}/out/*")
    return out.groupBy("shard_id").agg(F.count("*").alias("records"), F.countDistinct("seq").alias("unique_ids"), (F.min("number") > 0).alias("later"))


def _workers(spark):
    return spark.createDataFrame([("w1",), ("w2",), ("w3",), ("w9",)], "self string")


def lease_fair_share(spark, d):
    return leases.targets(lease_rows(spark, d), _workers(spark))


def lease_plan_actions(spark, d):
    return leases.plan_actions(leases.with_drained(lease_rows(spark, d)), _workers(spark))


def lease_steal_target(spark, d):
    rows = leases.with_drained(lease_rows(spark, d).withColumn("owner", F.when(F.col("owner") == "", "").when(F.col("counter") < 18, "w1").otherwise(F.col("owner"))))
    return leases.steal_targets(rows, leases.targets(rows, _workers(spark)))


def lease_parents_drained(spark, d):
    return leases.with_drained(lease_rows(spark, d)).select("shard_id", "checkpoint", "drained")


def lease_orphan_reap(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("key"))
    rows = n.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(8).cast("long"))))
    key, at = F.col("key"), F.col("pass")
    rows = rows.select("pass", F.format_string("shard-%03d", key).alias("shard_id"), ((at != 4) & ((key + at) % 5 < key % 4)).alias("listed"), (key % 3 != 0).alias("ended"), ((key % 7 == 0) & (at < 6)).alias("busy"))
    return leases.reaped(rows)


def lease_discovery_upsert(spark, d):
    rows = lease_rows(spark, d).filter("counter % 2 = 0")
    listed = lease_rows(spark, d).select("shard_id", "parents")
    return leases.discover(listed, rows).select("shard_id", "owner", "counter", "checkpoint", F.array_join("parents", ",").alias("parents"))


def lease_freshness(spark, d):
    """Events are heartbeats of their user's shard; what was observed at half time is held
    against the leases as they are at the end."""
    e = table(spark, d, "events").select(F.format_string("shard-%03d", F.col("user_id")).alias("shard_id"), F.col("event_id").alias("at"), F.concat(F.lit("w"), F.col("user_id") % 3).alias("owner"))
    end = e.agg(F.max("at")).first()[0] or 0
    observed = e.filter(F.col("at") <= end // 2).groupBy("shard_id").agg(F.count("*").alias("counter"), F.max("at").alias("seen_at"))
    now = e.groupBy("shard_id").agg(F.count("*").alias("counter"), F.max("owner").alias("owner"))
    seen = leases.refresh(now.select("shard_id", "counter"), observed, end).join(now.select("shard_id", "owner"), "shard_id")
    return seen.select("shard_id", "counter", F.col("seen_at").cast("long").alias("seen_at"), leases.fresh(F.col("owner"), F.col("seen_at"), F.lit(end), 500).alias("fresh"))


def lease_cas_fold(spark, d):
    e = table(spark, d, "events")
    kind = F.when(F.col("event_id") % 10 == 0, "ensure").otherwise(F.element_at(F.create_map(*[F.lit(x) for p in (("signup", "acquire"), ("click", "heartbeat"), ("view", "checkpoint"), ("purchase", "release"), ("error", "delete")) for x in p]), F.col("event_type")))
    ops = e.select(F.format_string("shard-%03d", F.col("user_id")).alias("shard_id"), F.col("event_id"), kind.alias("kind"), F.concat(F.lit("w"), F.col("event_id") % 2).alias("owner"), (F.floor(F.col("event_id") / 7) % 6).alias("expected"), F.col("event_id").cast("string").alias("seq"))
    return leases.apply_writes(ops, "shard_id", "event_id")


def lease_ownership_balance(spark, d):
    s = table(spark, d, "supplier").select(F.when(F.col("s_nationkey") % 4 == 0, "").otherwise(F.concat(F.lit("w"), F.col("s_nationkey") % 4)).alias("owner"))
    return leases.ownership(s)


def lease_row_roundtrip(spark, d):
    rows = lease_rows(spark, d).select("shard_id", "owner", "counter", "checkpoint", "parents")
    back = leases.unmarshal(leases.marshal(rows))
    same = back.join(rows.select("shard_id", F.struct("owner", "counter", "checkpoint", "parents").alias("was")), "shard_id")
    stored = leases.marshal(rows).select(F.col("leaseKey").alias("shard_id"), "leaseOwner", "leaseCounter", "parentShardId")
    equal = F.struct("owner", "counter", "checkpoint", "parents") == F.col("was")
    return same.join(stored, "shard_id").select("shard_id", F.coalesce("leaseOwner", F.lit("-")).alias("stored_owner"), F.col("leaseCounter").alias("stored_counter"), F.coalesce("parentShardId", F.lit("-")).alias("stored_parents"), equal.alias("equal"))


QUERIES = {f.__name__: f for f in (read_loop, receiver_figures, lease_reconcile, lease_store_history, shard_stream_restarts, chunk_requests, retry_transient, backoff_schedule, record_outcomes, checkpoint_prefix, stuck_passes, dead_letters, delivery_audit, lease_fair_share, lease_plan_actions, lease_steal_target, lease_parents_drained, lease_orphan_reap, lease_discovery_upsert, lease_freshness, lease_cas_fold, lease_ownership_balance, lease_row_roundtrip)}

SHARD = "printf('shard-%03d', user_id % 4)"
OUT = f"SELECT {SHARD} AS shard_id, event_id AS seq, user_id::VARCHAR AS partition_key, props, CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN 'Skip' WHEN event_type = 'signup' THEN 'Skip' WHEN event_type = 'error' THEN 'Retry' ELSE 'OK' END AS outcome, CASE WHEN event_id % 13 = 0 THEN 'decompress' WHEN event_id % 17 = 0 THEN 'decode' END AS failure_class FROM events"
LEASES = f"""SELECT printf('shard-%03d', n_nationkey) AS shard_id, CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE 'w' || (n_nationkey % 4) END AS owner, n_nationkey::BIGINT AS counter, CASE WHEN n_nationkey % 6 = 5 THEN '{SHARD_END}' ELSE '{TRIM_HORIZON}' END AS checkpoint, 'region-' || n_regionkey AS parent, n_nationkey % 4 <> 0 AND n_nationkey % 5 <> 0 AS fresh FROM nation
 UNION ALL SELECT 'region-' || r_regionkey, '', r_regionkey::BIGINT, CASE WHEN r_regionkey % 2 = 0 THEN '{SHARD_END}' ELSE '{TRIM_HORIZON}' END, NULL, false FROM region"""
PLAN = f"""l0 AS ({LEASES}), d AS (SELECT l.*, coalesce(p.checkpoint = '{SHARD_END}', true) AS drained FROM l0 l LEFT JOIN l0 p ON l.parent = p.shard_id), a AS (SELECT * FROM d WHERE checkpoint <> '{SHARD_END}'),
 w AS (SELECT unnest(['w1', 'w2', 'w3', 'w9']) AS self), t AS (SELECT self, (SELECT count(*) FROM a) AS shards, (SELECT count(DISTINCT owner) FROM a WHERE owner <> '' AND fresh AND owner <> self) + 1 AS workers FROM w),
 g AS (SELECT self, shards, workers, CASE WHEN shards = 0 THEN 0 ELSE (shards + workers - 1) // workers END AS target FROM t)"""
STEAL = "k AS (SELECT owner, count(*) AS n, min(shard_id) FILTER (drained) AS shard_id FROM a WHERE owner <> '' AND fresh GROUP BY 1), b AS (SELECT self, k.owner, k.shard_id, row_number() OVER (PARTITION BY self ORDER BY n DESC, k.owner) AS rn FROM g JOIN k ON k.owner <> self AND n > target), s AS (SELECT self, owner, shard_id FROM b WHERE rn = 1)"

ORACLES = {
    "chunk_requests": """WITH RECURSIVE o AS (SELECT o_custkey, strlen(o_orderpriority) * 3 AS s, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
 r AS (SELECT o_custkey, rn, s, 0 AS chunk, 1 AS n, s AS bytes FROM o WHERE rn = 1 UNION ALL
  SELECT o.o_custkey, o.rn, o.s, CASE WHEN r.n >= 3 OR r.bytes + o.s > 60 THEN r.chunk + 1 ELSE r.chunk END, CASE WHEN r.n >= 3 OR r.bytes + o.s > 60 THEN 1 ELSE r.n + 1 END, CASE WHEN r.n >= 3 OR r.bytes + o.s > 60 THEN o.s ELSE r.bytes + o.s END
  FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.rn = r.rn + 1)
 SELECT o_custkey, chunk, count(*) AS n, sum(s)::BIGINT AS bytes FROM r GROUP BY 1, 2""",
    "retry_transient": "SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'rejected' WHEN o_orderkey % 7 >= 5 THEN 'exhausted' ELSE 'sent' END AS result, CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey % 3 + 1 ELSE least(o_orderkey % 7 + 1, 5) END::INT AS attempts, count(*) AS entries FROM orders GROUP BY 1, 2",
    "backoff_schedule": "SELECT i AS step, least(2000, 100 * (2 ** i)::BIGINT)::BIGINT AS put_ms, CASE WHEN i <= 1 THEN 250 ELSE least(30000, 250 * (2 ** least(i - 1, 16))::BIGINT) END::BIGINT AS stuck_ms FROM range(21) t(i)",
    "record_outcomes": f"SELECT shard_id, outcome, coalesce(failure_class, '') AS failure_class, count(*) AS records FROM ({OUT}) GROUP BY 1, 2, 3",
    "checkpoint_prefix": f"WITH o AS ({OUT}), x AS (SELECT *, seq // {PAGE} AS page, coalesce(max((outcome = 'Retry')::INT) OVER (PARTITION BY shard_id, seq // {PAGE} ORDER BY seq), 0) AS stop FROM o) SELECT shard_id, page, max(seq) FILTER (stop = 0) AS checkpoint, max(seq) FILTER (stop = 0) IS NULL AND max(stop) = 1 AS stuck FROM x GROUP BY 1, 2",
    "stuck_passes": f"WITH o AS (SELECT *, seq // 8 AS page FROM ({OUT})), x AS (SELECT *, max((outcome = 'Retry')::INT) OVER (PARTITION BY shard_id, page ORDER BY seq) AS stop FROM o), p AS (SELECT shard_id, page, min(stop) = 1 AS stuck FROM x GROUP BY 1, 2), i AS (SELECT *, sum((NOT stuck)::INT) OVER (PARTITION BY shard_id ORDER BY page) AS run FROM p), r AS (SELECT shard_id, run, count(*) FILTER (stuck) AS n, count(*) AS k FROM i GROUP BY 1, 2) SELECT shard_id, sum(k)::BIGINT AS passes, max(n) AS longest FROM r GROUP BY 1",
    "dead_letters": f"SELECT shard_id, seq, 'kinesis.dead_letter' AS body, seq::VARCHAR AS sequence, partition_key, failure_class, 'otlp_json' AS encoding, 'zstd' AS codec, CASE failure_class WHEN 'decompress' THEN '{batches.JUNK}' ELSE '{batches.NOISE}' END || props AS held FROM ({OUT}) WHERE failure_class IS NOT NULL",
    "read_loop": f"WITH o AS ({OUT}) SELECT shard_id, '' AS owner, '{SHARD_END}' AS checkpoint, count(*) FILTER (outcome IN ('OK', 'Retry')) AS delivered, count(*) FILTER (failure_class IS NOT NULL) AS dead FROM o GROUP BY 1",
    "receiver_figures": "SELECT 'shards_owned' AS name, '' AS event, '' AS result, 0::BIGINT AS n UNION ALL SELECT 'lease_events', e, 'success', (SELECT count(DISTINCT user_id % 4) FROM events) FROM (VALUES ('acquire'), ('release')) v(e)",
    "lease_reconcile": "WITH n AS (SELECT count(*)::INT AS n FROM nation) SELECT step, replicas, n AS owned, ((n + replicas - 1) // replicas)::INT AS most, n AS polled FROM n, (VALUES (0, 1), (1, 2), (2, 3), (3, 2)) v(step, replicas)",
    "lease_store_history": "SELECT * FROM (VALUES (0, 'heartbeat', 'LeaseNotFound', NULL), (1, 'ensure', 'ok', NULL), (2, 'ensure', 'ok', NULL), (3, 'acquire', 'ok', 1), (4, 'acquire', 'LeaseConflict', NULL), (5, 'checkpoint', 'ok', 2), (6, 'heartbeat', 'LeaseConflict', NULL), (7, 'heartbeat', 'ok', 3), (8, 'delete', 'LeaseConflict', NULL), (9, 'release', 'ok', NULL), (10, 'delete', 'ok', NULL), (11, 'delete', 'ok', NULL), (12, 'acquire', 'LeaseNotFound', NULL)) v(step, write, answer, counter)",
    "shard_stream_restarts": "SELECT printf('shard-%03d', user_id % 4) AS shard_id, count(*) AS records, count(*) AS unique_ids, user_id % 4 = 3 AS later FROM events GROUP BY 1, 4",
    "delivery_audit": f"WITH o AS ({OUT}), n AS (SELECT count(*) AS e, count(*) FILTER (outcome = 'OK' AND seq % 29 = 0) AS x FROM o) SELECT e AS expected, e + x AS delivered, e AS unique_ids, 0::BIGINT AS loss, x AS dupes, greatest(5, e // 10) AS tolerance, x <= greatest(5, e // 10) AS \"within\" FROM n",
    "lease_fair_share": f"WITH {PLAN} SELECT * FROM g",
    "lease_steal_target": f"WITH {PLAN.replace('l0 AS (', 'l1 AS (', 1).replace(', d AS', chr(10) + ', l0 AS (SELECT * REPLACE (CASE WHEN owner = ' + chr(39) * 2 + ' THEN ' + chr(39) * 2 + ' WHEN counter < 18 THEN ' + chr(39) + 'w1' + chr(39) + ' ELSE owner END AS owner) FROM l1), d AS', 1)}, {STEAL} SELECT * FROM s",
    "lease_parents_drained": f"WITH {PLAN} SELECT shard_id, checkpoint, drained FROM d",
    "lease_plan_actions": f"""WITH {PLAN}, {STEAL}, x AS (SELECT g.self, target, shard_id, owner = self AND owner <> '' AS mine, NOT (owner = self AND owner <> '') AND drained AND (owner = '' OR NOT fresh) AS free FROM a CROSS JOIN g),
 y AS (SELECT *, count(*) FILTER (mine) OVER (PARTITION BY self) AS held, count(*) FILTER (free) OVER (PARTITION BY self) AS open, row_number() OVER (PARTITION BY self, mine, free ORDER BY shard_id) AS place FROM x)
 SELECT self, 'release' AS action, shard_id FROM y WHERE mine AND held > target AND place > target UNION ALL SELECT self, 'acquire', shard_id FROM y WHERE free AND place <= target - held
 UNION ALL SELECT self, 'steal', shard_id FROM s WHERE shard_id IS NOT NULL AND self IN (SELECT self FROM y WHERE target - held - open > 0)""",
    "lease_orphan_reap": """WITH r AS (SELECT p AS pass, printf('shard-%03d', n_nationkey) AS shard_id, p <> 4 AND (n_nationkey + p) % 5 < n_nationkey % 4 AS listed, n_nationkey % 3 <> 0 AS ended, n_nationkey % 7 = 0 AND p < 6 AS busy FROM nation CROSS JOIN range(1, 9) t(p)),
 k AS (SELECT * FROM r WHERE pass IN (SELECT pass FROM r WHERE listed) AND (listed OR ended)), i AS (SELECT *, sum(listed::INT) OVER (PARTITION BY shard_id ORDER BY pass) AS run FROM k), a AS (SELECT *, sum((NOT listed)::INT) OVER (PARTITION BY shard_id, run ORDER BY pass) AS absent FROM i)
 SELECT shard_id, min(pass) AS pass FROM a WHERE NOT listed AND NOT busy AND absent >= 3 GROUP BY 1""",
    "lease_discovery_upsert": f"WITH l AS ({LEASES}) SELECT shard_id, '' AS owner, 0::BIGINT AS counter, '{TRIM_HORIZON}' AS checkpoint, coalesce(parent, '') AS parents FROM l WHERE counter % 2 <> 0",
    "lease_freshness": "WITH e AS (SELECT printf('shard-%03d', user_id) AS shard_id, event_id AS t FROM events), n AS (SELECT max(t) AS now FROM e), o AS (SELECT shard_id, count(*) AS c, max(t) AS seen FROM e, n WHERE t <= now // 2 GROUP BY 1), c AS (SELECT shard_id, count(*) AS counter FROM e GROUP BY 1), s AS (SELECT c.shard_id, counter, CASE WHEN o.c = counter THEN seen ELSE now END AS seen_at, now FROM c LEFT JOIN o USING (shard_id) CROSS JOIN n) SELECT shard_id, counter, seen_at, now - seen_at < 500 AS fresh FROM s",
    "lease_cas_fold": """WITH RECURSIVE o AS (SELECT printf('shard-%03d', user_id) AS shard_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn, CASE WHEN event_id % 10 = 0 THEN 'ensure' ELSE CASE event_type WHEN 'signup' THEN 'acquire' WHEN 'click' THEN 'heartbeat' WHEN 'view' THEN 'checkpoint' WHEN 'purchase' THEN 'release' ELSE 'delete' END END AS kind, 'w' || (event_id % 2) AS who, (event_id // 7) % 6 AS expected, event_id::VARCHAR AS seq FROM events),
 s AS (SELECT DISTINCT shard_id, 0::BIGINT AS rn, false AS "exists", '' AS owner, 0::BIGINT AS counter, 'TRIM_HORIZON' AS checkpoint, 0::BIGINT AS ok, 0::BIGINT AS conflicts, 0::BIGINT AS missing FROM o UNION ALL
  SELECT shard_id, rn, CASE r WHEN 'made' THEN true WHEN 'gone' THEN false ELSE e END, CASE WHEN r IN ('made', 'gone') THEN '' WHEN r <> 'done' THEN owner WHEN kind = 'acquire' THEN who WHEN kind = 'release' THEN '' ELSE owner END, CASE WHEN r IN ('made', 'gone') THEN 0 WHEN r = 'done' THEN counter + 1 ELSE counter END, CASE WHEN r IN ('made', 'gone') THEN 'TRIM_HORIZON' WHEN r = 'done' AND kind = 'checkpoint' THEN seq ELSE checkpoint END, ok + (r IN ('made', 'gone', 'done'))::INT, conflicts + (r = 'lost')::INT, missing + (r = 'absent')::INT
  FROM (SELECT o.shard_id, o.rn, s."exists" AS e, s.owner, s.counter, s.checkpoint, s.ok, s.conflicts, s.missing, kind, who, seq, CASE WHEN kind = 'ensure' THEN CASE WHEN s."exists" THEN 'keep' ELSE 'made' END WHEN NOT s."exists" THEN CASE WHEN kind = 'delete' THEN 'keep' ELSE 'absent' END WHEN expected <> s.counter OR (kind NOT IN ('acquire', 'delete') AND s.owner <> who) THEN 'lost' WHEN kind = 'delete' THEN 'gone' ELSE 'done' END AS r FROM s JOIN o ON o.shard_id = s.shard_id AND o.rn = s.rn + 1))
 SELECT shard_id, "exists", owner, counter, checkpoint, ok, conflicts, missing FROM s QUALIFY rn = max(rn) OVER (PARTITION BY shard_id)""",
    "lease_ownership_balance": "WITH s AS (SELECT CASE WHEN s_nationkey % 4 = 0 THEN '' ELSE 'w' || (s_nationkey % 4) END AS owner FROM supplier), p AS (SELECT owner, count(*) AS n FROM s WHERE owner <> '' GROUP BY 1) SELECT sum(n)::BIGINT AS owned, (SELECT count(*) FROM s) AS total, count(*) AS owners, string_agg(owner || '=' || n || ';', '' ORDER BY owner) AS signature, max(n) - min(n) <= 1 AS balanced FROM p",
    "lease_row_roundtrip": f"WITH l AS ({LEASES}) SELECT shard_id, CASE WHEN owner = '' THEN '-' ELSE owner END AS stored_owner, counter::VARCHAR AS stored_counter, coalesce(parent, '-') AS stored_parents, true AS equal FROM l",
}
