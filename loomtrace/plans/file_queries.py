"""Queries of metrics over files and of evaluators over landed state; the files are made from the tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.files import build
from loomtrace.functions.file_metrics import EVALUATOR
from loomtrace.plans.expression import score_attempts
from loomtrace.plans import scripts
from loomtrace.plans.registry import query
from loomtrace.sources.tables import table


#: Tasks for each core where files are made and read: a row is small and takes milliseconds.
FILE_TASKS = 4


def _made(rows: DataFrame, key: str, make: Callable[[object], tuple[bytes, bytes]]) -> DataFrame:
    """(key, result, expected): two files for each row, made and read in tasks for all cores, however few files and splits the rows come in."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            files = [make(r) for r in batch.itertuples(index=False)]
            yield pd.DataFrame({key: batch[key].to_numpy(), "result": [a for a, _ in files], "expected": [b for _, b in files]})

    parts = FILE_TASKS * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(parts, key).mapInPandas(scan, f"{key} long, result binary, expected binary")


def _books(r) -> tuple[bytes, bytes]:
    rows = [["supplier", "balance"], [f"S{r.s_suppkey}", float(r.s_acctbal)], ["nation", int(r.s_nationkey)]]
    changed = [*rows[:1], [rows[1][0], rows[1][1] + (1 if r.s_suppkey % 3 == 0 else 1e-7)], *rows[2:]]
    return build.workbook({"A": rows}), build.workbook({"A": changed})


@query("q_book_files", "SELECT s_suppkey, (s_suppkey % 3 <> 0)::INT::DOUBLE AS score, (s_acctbal > 0)::INT::DOUBLE AS positive FROM supplier")
def book_files(spark, sf_dir):
    """Workbooks of every supplier compared by their values, and one of their cells by a rule."""
    pairs = _made(table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").cast("double").alias("s_acctbal"), "s_nationkey"), "s_suppkey", _books)
    same = EVALUATOR["compare_table"](F.col("result"), F.col("expected"), rules=[{"type": "sheet_name"}, {"type": "sheet_data", "sheet_idx0": 0, "sheet_idx1": "EI0", "precision": 4}])
    above = EVALUATOR["compare_table"](F.col("result"), rules=[{"type": "check_cell", "sheet_idx": "RNA", "coordinate": "B2", "props": {"value": {"method": "gt", "ref": 0}}}])
    return pairs.select("s_suppkey", same.alias("score"), above.alias("positive"))


def _decks(r) -> tuple[bytes, bytes]:
    slide = lambda text, left: [build.shape(text, rect=(left, 0, 500, 300)), build.shape("fixed")]
    bold = 'b="1"' if r.s_nationkey % 2 else 'b="0"'
    return build.deck([slide(r.s_name, 1000)]), build.deck([[build.shape(r.s_name, rect=(1000 + r.s_suppkey % 10, 0, 500, 300), run=bold), build.shape("fixed")]])


@query("q_deck_files", "SELECT s_suppkey, (s_suppkey % 10 <= 5 AND s_nationkey % 2 = 0)::INT::DOUBLE AS score, (s_suppkey % 10 <= 5)::INT::DOUBLE AS placed FROM supplier")
def deck_files(spark, sf_dir):
    """Decks of every supplier whose first shape is moved and turned bold in some."""
    pairs = _made(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey", _decks)
    same = lambda **options: EVALUATOR["compare_pptx_files"](F.col("result"), F.col("expected"), **options)
    return pairs.select("s_suppkey", same().alias("score"), same(examine_font_bold=False).alias("placed"))


def _texts(r) -> tuple[bytes, bytes]:
    words = [r.text, "", r.text.upper() if r.item_id % 2 else r.text + " end"]
    return build.document(words), build.document([r.text, words[2].lower() if r.item_id % 3 else r.text])


@query("q_document_files", """WITH t AS (SELECT item_id, text, CASE WHEN item_id % 2 = 1 THEN upper(text) ELSE text || ' end' END AS last FROM benchmark),
f AS (SELECT item_id, text, last, CASE WHEN item_id % 3 <> 0 THEN lower(last) ELSE text END AS other FROM t), n AS (SELECT item_id, trim(regexp_replace(text || ' ' || last, '\\s+', ' ', 'g')) AS a, trim(regexp_replace(text || ' ' || other, '\\s+', ' ', 'g')) AS b FROM f)
SELECT item_id, (a = b)::INT::DOUBLE AS score, (lower(a) = lower(b))::INT::DOUBLE AS folded FROM n""")
def document_files(spark, sf_dir):
    """Documents of every benchmark text compared without blanks, and without case."""
    pairs = _made(table(spark, sf_dir, "benchmark").select("item_id", "text"), "item_id", _texts)
    same = lambda **options: EVALUATOR["compare_docx_files"](F.col("result"), F.col("expected"), **options)
    return pairs.select("item_id", same().alias("score"), same(ignore_case=True).alias("folded"))


#: Tasks by the type of event that stands for an attempt, and their evaluators.
EVALUATORS = {
    "view": "exact_match(get_vm_command_line(env, config={'command': 'k'}), get_rule(env, config={'rules': {'expected': '7'}})) or check_include_exclude(get_vm_terminal_output(env), get_rule(env, config={'rules': {'include': ['5'], 'exclude': ['9']}}))",
    "click": "check_direct_json_object(get_active_tab_url_parse(env, config={'goto_prefix': 'https://', 'parse_keys': ['k', 'u']}), get_rule(env, config={'rules': {'expected': {'k': '7', 'u': ''}}})) or is_expected_url_pattern_match(get_active_url_from_accessTree(env, config={'goto_prefix': 'https://www.'}), get_rule(env, config={'rules': {'expected': ['^https', 'k=1']}}))",
    "purchase": "infeasible(get_(env, config={}))",
    "error": "check_json(get_vm_file(env, config={'path': '/p', 'dest': 'p.json'}), get_rule(env, config={'rules': {'expect': [{'key': ['k'], 'method': 'ge', 'ref': 50}]}})) and file_contains(get_vm_file(env, config={'path': '/p', 'dest': 'p.json'}), get_rule(env, config={'rules': {'expected': ['k']}}))",
    "signup": "no_such_metric(get_vm_terminal_output(env))",
}


@query("q_evaluators", """WITH a AS (SELECT event_id, event_type, event_id % 100 AS k, event_id % 4 = 0 AS failed FROM events)
SELECT event_id AS attempt, event_type AS task, CASE WHEN event_type = 'signup' THEN 0 WHEN event_type = 'purchase' THEN failed::INT WHEN failed THEN 0
  WHEN event_type = 'view' THEN (k = 7 OR (contains(k::VARCHAR, '5') AND NOT contains(k::VARCHAR, '9')))::INT
  WHEN event_type = 'click' THEN (k = 7 OR (k = 1 OR k BETWEEN 10 AND 19))::INT WHEN event_type = 'error' THEN (k >= 50)::INT ELSE 0 END::DOUBLE AS score,
  event_type NOT IN ('view', 'click', 'purchase', 'error') AS refused FROM a""")
def evaluators(spark, sf_dir):
    """Attempts of all events scored by their tasks' evaluators; those of unknown tasks and names are refused."""
    k = (F.col("event_id") % 100).cast("string")
    texts = F.create_map(F.lit('get_vm_command_line|{"command": "k"}'), k, F.lit("terminal"), k, F.lit("active_tab_url"), F.concat(F.lit("shop.org/x?k="), k))
    files = F.create_map(F.lit("p.json"), F.concat(F.lit('{"k": '), k, F.lit("}")).cast("binary"))
    action = F.when(F.col("event_id") % 4 == 0, "FAIL").otherwise("DONE")
    attempts = table(spark, sf_dir, "events").select(F.col("event_id").alias("attempt"), F.col("event_type").alias("task"), action.alias("last_action"), texts.alias("texts"), files.alias("files"))
    scored = score_attempts(attempts, EVALUATORS, EVALUATOR)
    return scored.select("attempt", "task", "score", F.col("error").isNotNull().alias("refused"))


@query("q_setup_steps", """SELECT page_id AS id, 1 + (page_id % 2)::BIGINT AS steps, (page_id % 5 = 4)::BIGINT AS wrong, CASE WHEN page_id % 5 <> 4 THEN page_id % 7 ELSE 0 END::DOUBLE AS seconds, CASE WHEN page_id % 2 = 1 THEN url END AS tab FROM pages""")
def setup_steps(spark, sf_dir):
    """Setup scripts of a task for every page, read into steps: a wait, in some not written right, and in every other one a tab."""
    wait = F.when(F.col("page_id") % 5 == 4, "_sleep_setup(sec=1)").otherwise(F.concat(F.lit("_sleep_setup(seconds="), F.col("page_id") % 7, F.lit(")")))
    tab = F.concat(F.lit("_chrome_open_tabs_setup(urls_to_open=['"), "url", F.lit("'])"))
    tasks = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.array(wait).alias("config"), F.when(F.col("page_id") % 2 == 1, F.array(tab)).alias("postconfig"))
    steps = scripts.setup_steps(tasks)
    counts = steps.groupBy("id").agg(F.count("*").alias("steps"), F.count("error").alias("wrong"))
    waits = scripts.waits(steps.filter("error is null")).groupBy("id").agg(F.sum("seconds").alias("seconds"))
    found = counts.join(waits, "id", "left").join(scripts.opened_tabs(steps).select("id", F.col("url").alias("tab")), "id", "left")
    return found.select("id", "steps", "wrong", F.coalesce("seconds", F.lit(0.0)).alias("seconds"), "tab")
