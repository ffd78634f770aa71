"""Queries of memory, results, task corpora and near-duplicate tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.operators import dedup, memory
from loomtrace.plans import replay_queries  # noqa: F401  (its SQL is used below)
from loomtrace.plans.registry import ORACLES, query
from loomtrace.sources.tables import table


@query("q_domain_limit", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 3 ORDER BY source, doc_id LIMIT 40")
def domain_limit(spark, sf_dir):
    """The first three tasks of each domain and forty of all."""
    return memory.first_n(table(spark, sf_dir, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 3, 40)


_DIGEST = "sum(('0x' || substr(md5({id}::VARCHAR), 1, 8))::BIGINT)::BIGINT"


def _digest(ids: Column) -> Column:
    """The sum of hashes of ids, which does not depend on their order."""
    return F.sum(F.conv(F.substring(F.md5(ids.cast("string").cast("binary")), 1, 8), 16, 10).cast("long"))


@query("q_manifest", f"SELECT lang, count(DISTINCT doc_id) AS n, min(doc_id) AS low, max(doc_id) AS high, {_DIGEST.format(id='doc_id')} AS ids FROM (SELECT DISTINCT lang, doc_id FROM documents) GROUP BY lang")
def manifest(spark, sf_dir):
    """The ids of each language, as their number, their ends and a digest."""
    found = memory.manifest(table(spark, sf_dir, "documents"), "lang", "doc_id")
    return found.groupBy("lang").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"), _digest(F.col("id")).alias("ids"))


@query("q_manifest_merge", f"SELECT lang, count(*) AS n, min(doc_id) AS low, {_DIGEST.format(id='doc_id')} AS ids FROM (SELECT DISTINCT lang, doc_id FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0) GROUP BY lang")
def manifest_merge(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    both = memory.merge_manifests(memory.manifest(docs.filter("doc_id % 2 = 0"), "lang", "doc_id"), memory.manifest(docs.filter("doc_id % 3 = 0"), "lang", "doc_id"))
    return both.groupBy("lang").agg(F.count("*").alias("n"), F.min("id").alias("low"), _digest(F.col("id")).alias("ids"))


@query("q_upsert_last_wins", """SELECT user_id, event_type, arg_max(event_id, struct_pack(t := ts, e := event_id)) AS event_id, arg_max(value, struct_pack(t := ts, e := event_id)) AS value,
  arg_min(event_id, struct_pack(t := ts, e := event_id)) AS first_event FROM events GROUP BY user_id, event_type""")
def upsert_last_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return memory.upsert(rows, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value", F.col("first_seen.event_id").alias("first_event"))


def _memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as memory entries: quality is executable, toxic solvable, and without a label both are unknown."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("executable"), (F.col("toxic") == 1).alias("solvable"))
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text").join(labels, "doc_id", "left")


_MEMORY = "WITH m AS (SELECT d.doc_id, d.source, d.text, l.quality = 1 AS executable, l.toxic = 1 AS solvable FROM documents d LEFT JOIN labels l USING (doc_id)), k AS (SELECT *, CASE WHEN coalesce(solvable, false) THEN 'solvable' WHEN coalesce(executable, false) THEN 'executable' ELSE 'failed' END AS class FROM m) "


@query("q_class_three_way", _MEMORY + "SELECT source, class, count(*) AS n FROM k GROUP BY source, class")
def class_three_way(spark, sf_dir):
    rows = _memory(spark, sf_dir).select("source", memory.memory_class(F.col("executable"), F.col("solvable")).alias("class"))
    return rows.groupBy("source", "class").agg(F.count("*").alias("n"))


@query("q_last_n_per_class", _MEMORY + "SELECT source, class, doc_id, n AS place FROM (SELECT *, row_number() OVER (PARTITION BY source, class ORDER BY doc_id DESC) AS n FROM k) WHERE n <= 5")
def last_n_per_class(spark, sf_dir):
    rows = _memory(spark, sf_dir).select("source", memory.memory_class(F.col("executable"), F.col("solvable")).alias("class"), "doc_id")
    return memory.last_n(rows, ["source", "class"], ["doc_id"], 5)


@query("q_failure_top10", """WITH r AS (SELECT unnest(['step ' || event_type || ' error=code ' || (event_id % 17), 'fine']) AS reason FROM events)
SELECT substr(string_split(reason, 'error=')[-1], 1, 60) AS keyword, count(*) AS n FROM r WHERE contains(reason, 'error=') GROUP BY keyword ORDER BY n DESC, keyword LIMIT 10""")
def failure_top10(spark, sf_dir):
    reasons = F.array(F.concat(F.lit("step "), "event_type", F.lit(" error=code "), F.col("event_id") % 17), F.lit("fine"))
    return memory.failure_keywords(table(spark, sf_dir, "events").select(reasons.alias("reasons")), "reasons")


@query("q_memory_stats", _MEMORY + "SELECT count(*) AS total, count(*) FILTER (executable) AS executable, count(*) FILTER (solvable) AS solvable FROM m")
def memory_stats(spark, sf_dir):
    return memory.memory_stats(_memory(spark, sf_dir))


@query("q_result_class", "SELECT CASE WHEN event_type = 'error' THEN 'errored' WHEN value > 0 THEN 'solvable' ELSE 'unsolvable' END AS class, count(*) AS n FROM events GROUP BY class")
def result_class(spark, sf_dir):
    error = F.when(F.col("event_type") == "error", "e")
    return table(spark, sf_dir, "events").groupBy(memory.result_class(F.col("value"), error).alias("class")).agg(F.count("*").alias("n"))


@query("q_avg_excl_errors", "SELECT round(coalesce(avg(value) FILTER (event_type <> 'error'), 0), 6) AS avg_score, count(*) FILTER (event_type = 'purchase') AS done, count(*) FILTER (event_type = 'error') AS errored FROM events")
def avg_excl_errors(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("value").alias("score"), (F.col("event_type") == "purchase").alias("done"), F.when(F.col("event_type") == "error", "e").alias("error"))
    return memory.run_summary(rows).withColumn("avg_score", F.round("avg_score", 6))


@query("q_pending_anti_join", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic IS NOT NULL)")
def pending_anti_join(spark, sf_dir):
    tested = table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("solvable"))
    return memory.pending(table(spark, sf_dir, "documents").select("doc_id"), tested, "doc_id")


@query("q_results_join", "SELECT d.doc_id, d.source, l.quality::BIGINT AS score FROM documents d JOIN labels l USING (doc_id)")
def results_join(spark, sf_dir):
    """Results joined to their tasks by id."""
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("score")), "doc_id")


@query("q_task_text", "SELECT doc_id, md5(trim(text) || CASE WHEN trim(lang) <> '' AND doc_id % 2 = 0 THEN chr(10) || chr(10) || 'VERIFIER: ' || trim(lang) ELSE '' END) AS body FROM documents")
def task_text(spark, sf_dir):
    text = memory.task_text(F.col("text"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(" "))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.cast("binary")).alias("body"))


@query("q_timing_summary", """WITH t AS (SELECT l_orderkey, min(l_quantity) AS reset_time, list(l_extendedprice / 1000) AS steps, max(l_quantity) AS finish_time, sum(l_quantity) AS total_time, bool_or(l_returnflag = 'A') AS success FROM lineitem GROUP BY l_orderkey)
SELECT count(*) AS tasks, count(*) FILTER (success) AS succeeded, round(avg(reset_time), 6) AS avg_reset, round(sum(list_sum(steps)) / sum(len(steps)), 4) AS avg_step, round(avg(finish_time), 6) AS avg_finish, round(avg(total_time), 6) AS avg_total, round(sum(total_time) / max(total_time), 6) AS potential_speedup FROM t""")
def timing_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_quantity").cast("double").alias("reset_time"), F.collect_list(F.col("l_extendedprice") / 1000).alias("step_times"), F.max("l_quantity").cast("double").alias("finish_time"),
        F.sum("l_quantity").cast("double").alias("total_time"), F.bool_or(F.col("l_returnflag") == "A").alias("success"),
    )
    found = memory.timing_summary(rows)
    return found.select("tasks", "succeeded", *[F.round(c, 4 if c == "avg_step" else 6).alias(c) for c in ("avg_reset", "avg_step", "avg_finish", "avg_total", "potential_speedup")])


# --- near-duplicate tasks -----------------------------------------------------

#: The tables' vectors are far apart; this threshold makes the filters bite.
NEAR = 0.3


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("domain"), "embedding")


_PAIRS = f"""WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id AS id, label AS domain, embedding::DOUBLE[] AS e FROM embeddings),
p AS MATERIALIZED (SELECT a.id, b.id AS other, a.domain, list_cosine_similarity(a.e, b.e) AS s FROM v a JOIN v b ON a.domain = b.domain AND b.id < a.id WHERE list_cosine_similarity(a.e, b.e) >= {NEAR})"""


@query("q_cosine_top1", _PAIRS + "SELECT id, domain, arg_max(other, struct_pack(s := s, o := -other)) AS other, round(max(s), 6) AS similarity FROM p GROUP BY id, domain")
def cosine_top1(spark, sf_dir):
    tasks = _tasks(spark, sf_dir)
    return dedup.nearest(tasks, tasks, NEAR, earlier=True).select("id", "domain", "other", F.round("similarity", 6).alias("similarity"))


@query("q_dedup_db_reject", f"""WITH v AS (SELECT vec_id AS id, label AS domain, embedding::DOUBLE[] AS e FROM embeddings)
SELECT id, domain FROM v a WHERE id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM v b WHERE b.id % 2 = 0 AND a.domain = b.domain AND list_cosine_similarity(a.e, b.e) >= {NEAR})""")
def dedup_db_reject(spark, sf_dir):
    """New tasks (odd ids) that no stored one (even ids) is near to."""
    tasks = _tasks(spark, sf_dir)
    return dedup.reject_stored(tasks.filter("id % 2 = 1"), tasks.filter("id % 2 = 0"), NEAR).select("id", "domain")


@query("q_dedup_greedy", _PAIRS + """, n AS (SELECT id, row_number() OVER (ORDER BY id) AS k FROM v), walk(k, kept) AS (
  SELECT 0::BIGINT, []::BIGINT[] UNION ALL
  SELECT w.k + 1, CASE WHEN EXISTS (SELECT 1 FROM p WHERE p.id = n.id AND list_contains(w.kept, p.other)) THEN w.kept ELSE list_append(w.kept, n.id) END FROM walk w JOIN n ON n.k = w.k + 1)
SELECT v.id, v.domain, list_contains(kept, v.id) AS accepted, CASE WHEN NOT list_contains(kept, v.id) THEN (SELECT min(other) FROM p WHERE p.id = v.id AND list_contains(kept, other)) END AS match
FROM v, (SELECT kept FROM walk ORDER BY k DESC LIMIT 1)""")
def dedup_greedy(spark, sf_dir):
    return dedup.greedy(_tasks(spark, sf_dir), NEAR)


@query("q_vector_count", "SELECT label AS domain, count(*) AS n FROM embeddings GROUP BY label")
def vector_count(spark, sf_dir):
    return _tasks(spark, sf_dir).groupBy("domain").agg(F.count("*").alias("n"))


@query("q_session_inactivity", """WITH s AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM s)
SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 6 HOUR AS released, count(*) AS requests FROM n GROUP BY user_id, session""")
def session_inactivity(spark, sf_dir):
    """Sessions that end six hours after the last request of a worker."""
    rows = table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "6 hours").alias("s")).agg(F.count("*").alias("requests"))
    return rows.select("user_id", F.col("s.start").alias("started"), F.col("s.end").alias("released"), "requests")


@query("q_stream_replay", ORACLES["q_discounted_returns"])
def stream_replay(spark, sf_dir):
    """The returns that the streaming processor emits for the whole events table; equal to the batch query's."""
    from loomtrace.streaming.replay import replay_available

    return replay_available(spark, table(spark, sf_dir, "events"), 0.9)
