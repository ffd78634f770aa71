"""Queries over stores that are kept in versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtrace.operators.vector_index import VectorIndex
from loomtrace.plans.memory_queries import NEAR, _tasks
from loomtrace.plans.registry import ORACLES, query
from loomtrace.plans.replay_queries import CAPACITY, GAMMA, _steps
from loomtrace.plans.synthesis import SynthesisLoop
from loomtrace.sources.shared import new_folder
from loomtrace.sources.snapshots import KeyedStore
from loomtrace.sources.tables import table

_LAST = "SELECT client_id, max(struct_pack(k := coalesce(valid_at, TIMESTAMP '1900-01-01'), s := seq, c := change_id, o := op, a := source, g := segment, t := city, b := balance, v := valid_at)) AS x FROM client_changes GROUP BY client_id"


@query("q_store_upsert", f"SELECT client_id, x.c AS change_id, x.v AS valid_at, x.g AS segment, x.t AS city, x.b AS balance FROM ({_LAST}) WHERE x.o IS DISTINCT FROM 'D'")
def store_upsert(spark, sf_dir):
    """The clients that a store holds after all changes: put in by three writers in turn, one of which repeats its batch."""
    changes = table(spark, sf_dir, "client_changes").withColumn("gone", F.coalesce(F.col("op") == "D", F.lit(False)))
    store = KeyedStore(spark, new_folder(spark, "clients"), ["client_id"], ["valid_at", "seq", "change_id"], buckets=16, gone="gone")
    for writer in (2, 0, 1, 0):
        store.upsert(changes.filter(F.pmod("change_id", F.lit(3)) == writer), f"writer {writer}", 0)
    return store.read().select("client_id", "change_id", "valid_at", "segment", "city", "balance")


@query("q_store_version", f"SELECT client_id, x.c AS change_id, x.v AS valid_at FROM ({_LAST.replace('client_changes', 'client_changes WHERE change_id % 2 = 0')})")
def store_version(spark, sf_dir):
    """The last change of every client as the store's first version had it, read after a second one."""
    changes = table(spark, sf_dir, "client_changes")
    store = KeyedStore(spark, new_folder(spark, "clients"), ["client_id"], ["valid_at", "seq", "change_id"], buckets=16)
    first = store.upsert(changes.filter("change_id % 2 = 0"))
    store.upsert(changes)
    return store.read(first).select("client_id", "change_id", "valid_at")


@query("q_vector_index", f"""WITH v AS (SELECT vec_id AS id, label AS domain, embedding::DOUBLE[] AS e FROM embeddings)
SELECT a.id, b.id AS other, a.domain, round(list_cosine_similarity(a.e, b.e), 6) AS similarity FROM v a JOIN v b ON a.domain = b.domain AND a.id % 4 = 3 AND b.id % 4 <> 3 WHERE list_cosine_similarity(a.e, b.e) >= {NEAR}""")
def vector_index(spark, sf_dir):
    """The stored vectors near to every fourth one, after a kept index took the others in three inserts, one of them twice."""
    tasks = _tasks(spark, sf_dir)
    index = VectorIndex(spark, new_folder(spark, "vectors"), parts=16)
    for turn in (0, 1, 2, 1):
        index.insert(tasks.filter(F.pmod("id", F.lit(4)) == turn))
    return index.near(tasks.filter(F.pmod("id", F.lit(4)) == 3), NEAR).select("id", "other", "domain", F.round("similarity", 6).alias("similarity"))


@query("q_worker_log", ORACLES["q_discounted_returns"])
def worker_log(spark, sf_dir):
    """Returns of all events that a stream of a log of workers emits, after a streaming sink wrote the log."""
    from loomtrace.streaming.replay import replay_from_log

    return replay_from_log(spark, table(spark, sf_dir, "events"), GAMMA)


@query("q_stream_ring", ORACLES["q_ring_last_n"])
def stream_ring(spark, sf_dir):
    """What the streaming buffer's ring holds after all completed steps came in four triggers."""
    from loomtrace.streaming.replay import buffer_available

    return buffer_available(spark, _steps(spark, sf_dir), CAPACITY, 0.99).read().select("worker_id", "ep", "step", "seq")


@query("q_stream_mean", ORACLES["q_running_reward_ema"])
def stream_mean(spark, sf_dir):
    """The running reward that the streaming buffer has after all completed steps came in four triggers."""
    from loomtrace.streaming.replay import buffer_available

    value = buffer_available(spark, _steps(spark, sf_dir), CAPACITY, 0.99).running_reward()
    return spark.createDataFrame([(round(value, 6),)], "running_reward double")


@query("q_synthesis_rounds", """WITH c AS (SELECT vec_id AS id, label AS domain, vec_id % 3 AS round FROM embeddings WHERE vec_id % 3 < 2 AND vec_id % 7 <> 0)
SELECT id, domain, round::INT AS round FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY round, id) AS n FROM c) WHERE n <= 30""")
def synthesis_rounds(spark, sf_dir):
    """Tasks that two rounds take for a quota of thirty a domain, from candidates of which every seventh is not valid and none is near another."""
    tasks = _tasks(spark, sf_dir)
    quotas = tasks.select("domain").distinct().withColumn("quota", F.lit(30).cast("long"))
    propose = lambda short, number: tasks.filter(F.pmod("id", F.lit(3)) == number).join(short, "domain", "left_semi")
    loop = SynthesisLoop(spark, new_folder(spark, "synthesis"), quotas, propose, F.pmod(F.col("id"), F.lit(7)) != 0, threshold=1.01)
    loop.run(most=2)
    return loop.tasks.read().select("id", "domain", "round")


@query("q_session_timers", ORACLES["q_session_inactivity"])
def session_timers(spark, sf_dir):
    """Sessions that end six hours after the last request of a worker, by timers of a stream of all events."""
    from loomtrace.streaming.sessions import sessions_available

    requests = table(spark, sf_dir, "events").select(F.col("user_id").alias("worker_id"), "ts")
    return sessions_available(spark, requests, 6 * 3600).withColumnRenamed("worker_id", "user_id")
