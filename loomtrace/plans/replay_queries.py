"""Queries of the experience stream: episodes, returns, the replay buffer and rollout texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtrace.functions import text as T
from loomtrace.operators import replay
from loomtrace.plans.registry import query
from loomtrace.sources.tables import table

_EP = """
WITH s AS (SELECT *, event_type = 'purchase' AS done FROM events WHERE event_type <> 'signup'),
e AS (SELECT *, coalesce(sum(done::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ep FROM s),
c AS (SELECT *, row_number() OVER w AS step, max(done::INT) OVER p AS complete, count(*) OVER p AS n_steps, max(ts) OVER p AS flush_ts, max(event_id) FILTER (done) OVER p AS flush_seq
      FROM e WINDOW w AS (PARTITION BY user_id, ep ORDER BY ts, event_id), p AS (PARTITION BY user_id, ep)),
steps AS (SELECT * FROM c WHERE complete = 1),
g AS (SELECT user_id, ep, step, event_id, value, list_reduce(list_prepend(0.0::DOUBLE, list_reverse(list(value) OVER (PARTITION BY user_id, ep ORDER BY step ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))), lambda a, x: x + 0.9 * a) AS g FROM steps)
"""

GAMMA, BALANCE_AT, CAPACITY = 0.9, 60.0, 500


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.steps_of_events(table(spark, sf_dir, "events"))


@query("q_discounted_returns", _EP + "SELECT user_id AS worker_id, ep, step, event_id AS seq, round(g, 6) AS g FROM g")
def discounted_returns(spark, sf_dir):
    """The discounted return of every step of a complete episode."""
    return replay.discounted_returns(_steps(spark, sf_dir), GAMMA).select("worker_id", "ep", "step", "seq", F.round("g", 6).alias("g"))


@query("q_outcome_only", _EP + "SELECT user_id AS worker_id, ep, event_id AS seq, value AS reward, n_steps FROM steps WHERE step = n_steps")
def outcome_only(spark, sf_dir):
    return replay.outcome_only(_steps(spark, sf_dir)).select("worker_id", "ep", "seq", "reward", "n_steps")


@query("q_ring_last_n", _EP + f"SELECT user_id AS worker_id, ep, step, event_id AS seq FROM steps ORDER BY flush_ts DESC, flush_seq DESC, step DESC LIMIT {CAPACITY}")
def ring_last_n(spark, sf_dir):
    return replay.ring(_steps(spark, sf_dir), CAPACITY).select("worker_id", "ep", "step", "seq")


@query("q_balance_stats", _EP + f"SELECT count(*) FILTER (g < {BALANCE_AT}) AS below, count(*) FILTER (g >= {BALANCE_AT}) AS above FROM g")
def balance_stats(spark, sf_dir):
    return replay.balance(replay.discounted_returns(_steps(spark, sf_dir), GAMMA), "g", BALANCE_AT)


@query("q_balance_keep", _EP + f""", b AS (SELECT count(*) FILTER (g < {BALANCE_AT}) AS lo, count(*) FILTER (g >= {BALANCE_AT}) AS hi FROM g), r AS (SELECT (hi - lo) / (hi + lo + 1e-8) AS rate FROM b)
SELECT event_id AS seq, round(g, 6) AS g FROM g, r WHERE abs(rate) < 0.1 OR (rate > 0 AND g < {BALANCE_AT}) OR (rate <= 0 AND g > {BALANCE_AT})""")
def balance_keep(spark, sf_dir):
    returns = replay.discounted_returns(_steps(spark, sf_dir), GAMMA).select("seq", "g")
    return replay.balanced(returns, "g", BALANCE_AT).select("seq", F.round("g", 6).alias("g"))


@query("q_uid_histogram", _EP + "SELECT n_steps, count(*) AS episodes FROM steps WHERE step = 1 GROUP BY n_steps")
def uid_histogram(spark, sf_dir):
    return replay.length_histogram(_steps(spark, sf_dir))


@query("q_outcome_reward_avg", "SELECT round(coalesce(avg(value) FILTER (event_type = 'purchase'), 0), 6) AS outcome_reward FROM events")
def outcome_reward_avg(spark, sf_dir):
    return replay.outcome_reward(_steps(spark, sf_dir)).select(F.round("outcome_reward", 6).alias("outcome_reward"))


@query("q_running_reward_ema", "SELECT round(list_reduce(list_prepend(0.0::DOUBLE, list(value ORDER BY ts, event_id)), lambda a, x: 0.99 * a + 0.01 * x), 6) AS running_reward FROM events WHERE event_type = 'purchase'")
def running_reward_ema(spark, sf_dir):
    return replay.running_reward(_steps(spark, sf_dir)).select(F.round("running_reward", 6).alias("running_reward"))


@query("q_fifo_ready_batch", """SELECT worker_id, seq FROM (SELECT user_id AS worker_id, arg_min(event_id, struct_pack(ts := ts, e := event_id)) AS seq FROM events GROUP BY user_id) ORDER BY md5('5:' || worker_id), worker_id LIMIT 32""")
def fifo_ready_batch(spark, sf_dir):
    return replay.oldest_of_ready_workers(_steps(spark, sf_dir), 32, seed=5).select("worker_id", "seq")


@query("q_least_progressed", "SELECT user_id AS worker_id, count(*) AS n_steps FROM events GROUP BY user_id ORDER BY n_steps, worker_id LIMIT 16")
def least_progressed(spark, sf_dir):
    return replay.least_progressed(_steps(spark, sf_dir), 16)


@query("q_sample_hash", _EP + "SELECT event_id AS seq, value AS reward FROM steps ORDER BY md5('3:' || event_id), event_id LIMIT 100")
def sample_hash(spark, sf_dir):
    return replay.sample_by_hash(replay.completed_steps(_steps(spark, sf_dir)).select("seq", "reward"), "seq", 100, seed=3)


@query("q_force_finish", _EP + "SELECT event_id AS seq, step, CASE WHEN step >= 5 THEN 'finish()' ELSE event_type END AS action FROM steps")
def force_finish(spark, sf_dir):
    return replay.force_finish(_steps(spark, sf_dir), 5).select("seq", "step", "action")


#: Ids of a batch: its rows come from that many on end.
BATCH = 1_000


@query("q_batch_collate", _EP + f"SELECT n_steps, event_id // {BATCH} AS batch, md5(string_agg(event_id::VARCHAR, ',' ORDER BY event_id)) AS seqs, count(*) AS n FROM steps GROUP BY n_steps, batch")
def batch_collate(spark, sf_dir):
    """Rows pivoted to one row of columns for each batch, of BATCH rows at most."""
    steps = replay.completed_steps(_steps(spark, sf_dir))
    listed = F.transform(F.array_sort(F.collect_list("seq")), lambda x: x.cast("string"))
    batch = F.floor(F.col("seq") / BATCH).alias("batch")
    return steps.groupBy("n_steps", batch).agg(F.md5(F.array_join(listed, ",").cast("binary")).alias("seqs"), F.count("*").alias("n"))


# --- texts of rollouts --------------------------------------------------------

def _turns():
    return Window.partitionBy("conv_id").orderBy("turn")


@query("q_prompt_cumulative", "SELECT conv_id, turn, md5(coalesce(string_agg(text, '' ) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')) AS prompt FROM conversations")
def prompt_cumulative(spark, sf_dir):
    """What a turn sees: all turns before it, put together."""
    before = F.array_join(F.collect_list("text").over(_turns().rowsBetween(Window.unboundedPreceding, -1)), "")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(before.cast("binary")).alias("prompt"))


@query("q_history_window", "SELECT conv_id, turn, md5(coalesce(string_agg(role || ':' || text, '|') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), '')) AS history FROM conversations")
def history_window(spark, sf_dir):
    """The last two turns before each turn."""
    item = F.concat("role", F.lit(":"), "text")
    history = F.array_join(F.collect_list(item).over(_turns().rowsBetween(-2, -1)), "|")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(history.cast("binary")).alias("history"))


@query("q_vision_tag_replace", """WITH t AS (SELECT conv_id, turn, '<|vision_start|>' || role || chr(10) || turn || '<|vision_end|>' || text || '<|vision_start|>x<|vision_end|>' AS s FROM conversations)
SELECT conv_id, turn, md5(regexp_replace(s, '(?s)<\\|vision_start\\|>(.*?)<\\|vision_end\\|>', '<image>', 'g')) AS text, array_to_string(regexp_extract_all(s, '(?s)<\\|vision_start\\|>(.*?)<\\|vision_end\\|>', 1), ',') AS images FROM t""")
def vision_tag_replace(spark, sf_dir):
    marked = F.concat(F.lit("<|vision_start|>"), "role", F.lit("\n"), "turn", F.lit("<|vision_end|>"), "text", F.lit("<|vision_start|>x<|vision_end|>"))
    plain, images = T.vision_tags(F.col("s"))
    return table(spark, sf_dir, "conversations").withColumn("s", marked).select("conv_id", "turn", F.md5(plain.cast("binary")).alias("text"), F.array_join(images, ",").alias("images"))


_ACTIONS = "CASE event_type WHEN 'view' THEN 'click(' || (event_id % 1000) || ', ' || (user_id % 1000) || ')' WHEN 'click' THEN 'scroll(' || (event_id % 1000) || ',' || (user_id % 1000) || ',up)' WHEN 'purchase' THEN 'finish()' WHEN 'error' THEN 'fly(1)' ELSE 'nothing here' END"


@query("q_action_parse", f"""WITH a AS (SELECT event_id, {_ACTIONS} AS act FROM events)
SELECT event_id, CASE WHEN regexp_matches(act, '^\\w+\\(') THEN regexp_extract(act, '^(\\w+)\\(', 1) END AS name,
  CASE WHEN regexp_matches(act, '^\\w+\\(') THEN CASE WHEN act LIKE '%()' THEN 0 ELSE len(string_split(regexp_extract(act, '\\((.*?)\\)', 1), ',')) END END AS n_args FROM a""")
def action_parse(spark, sf_dir):
    name, args = T.parse_action(F.expr(_ACTIONS))
    return table(spark, sf_dir, "events").select("event_id", name.alias("name"), F.when(args.isNotNull(), F.size(args)).cast("long").alias("n_args"))


@query("q_action_denormalise", """SELECT event_id, CASE event_type
  WHEN 'view' THEN 'click(' || trunc((event_id % 1000) / 1000.0::DOUBLE * 1260)::INT || ',' || trunc((user_id % 1000) / 1000.0::DOUBLE * 700)::INT || ')'
  WHEN 'click' THEN 'scroll(' || trunc((event_id % 1000) / 1000.0::DOUBLE * 1260)::INT || ',' || trunc((user_id % 1000) / 1000.0::DOUBLE * 700)::INT || ',50)'
  WHEN 'purchase' THEN 'finish()' ELSE 'wait()' END AS action FROM events""")
def action_denormalise(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", T.valid_action(F.expr(_ACTIONS), 1260, 700).alias("action"))


@query("q_token_pad_truncate", """WITH t AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda x: length(x)::BIGINT) AS ids FROM documents), p AS (
  SELECT doc_id, ids, list_resize([]::BIGINT[], greatest(0, 16 - len(ids)), 0) AS pad FROM t)
SELECT doc_id, array_to_string(list_concat(pad, ids[greatest(1, len(ids) - 15):]), ',') AS prompt, array_to_string(list_concat(ids[1:16], pad), ',') AS response FROM p""")
def token_pad_truncate(spark, sf_dir):
    ids = F.transform(F.split("text", " "), lambda x: F.length(x).cast("long"))
    shown = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    docs = table(spark, sf_dir, "documents").select("doc_id", ids.alias("ids"))
    return docs.select("doc_id", shown(T.pad_left(F.col("ids"), 16)).alias("prompt"), shown(T.pad_right(F.col("ids"), 16)).alias("response"))


_ANSWER = "CASE doc_id % 4 WHEN 0 THEN '{\"a\": ' || doc_id || '}' WHEN 1 THEN 'x ```json\n{\"a\": ' || doc_id || '}\n``` y' WHEN 2 THEN 'so {\"a\": {\"b\": ' || doc_id || '}} ends' ELSE 'none' END"


@query("q_answer_json", """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '{"a": ' || doc_id || '}' WHEN 1 THEN '{"a": ' || doc_id || '}' WHEN 2 THEN '{"a": {"b": ' || doc_id || '}}' END AS body FROM documents""")
def answer_json(spark, sf_dir):
    """The JSON object in an answer."""
    return table(spark, sf_dir, "documents").select("doc_id", T.json_of_answer(F.expr(_ANSWER)).alias("body"))


@query("q_answer_code", """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'x = ' || doc_id WHEN 1 THEN 'y = ' || doc_id ELSE 'z' END AS code FROM documents""")
def answer_code(spark, sf_dir):
    """The code of an answer, from its first fence."""
    answer = F.expr("CASE doc_id % 3 WHEN 0 THEN 'a ```\nb\n``` ```python\nx = ' || doc_id || '\n```' WHEN 1 THEN '```\ny = ' || doc_id || '\n``` b' ELSE ' z ' END")
    return table(spark, sf_dir, "documents").select("doc_id", T.fenced_code(answer).alias("code"))


@query("q_answer_sections", """SELECT conv_id, turn, role AS observation, 1::BIGINT AS n_steps, 'a' || turn AS last_action FROM conversations""")
def answer_sections(spark, sf_dir):
    """Observation and paired thoughts and actions of an answer; a thought without an action is left out."""
    answer = F.concat(F.lit("<Observation> "), "role", F.lit("\n</observation><thought>t1</thought><ACTION>a"), "turn", F.lit("</action><thought>t2</thought>"))
    seen, steps = T.sections(answer)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", seen.alias("observation"), F.size(steps).cast("long").alias("n_steps"), F.element_at(steps, -1)["action"].alias("last_action"))
