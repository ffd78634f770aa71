"""Queries of the rule language and of comparisons of texts, tables and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.functions import landed as L
from loomtrace.functions import rules as R
from loomtrace.functions import text as T
from loomtrace.functions.mail import mail_messages
from loomtrace.functions.metrics import METRICS
from loomtrace.operators import compare as C
from loomtrace.plans.expression import score_expression, validate_tasks
from loomtrace.plans.registry import query
from loomtrace.sources.tables import table


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


# --- rules ----------------------------------------------------------------------


@query("q_rule_eq_ne_cmp", "SELECT l_orderkey, l_linenumber::BIGINT AS line, l_quantity = 5 AS eq, l_returnflag <> 'A' AS ne, l_quantity <= 10 AS le, l_quantity > 30 AS gt FROM lineitem")
def rule_compare(spark, sf_dir):
    q, f = F.col("l_quantity"), F.col("l_returnflag")
    tests = [R.rule(q, "eq", 5).alias("eq"), R.rule(f, "ne", "A").alias("ne"), R.rule(q, "le", 10).alias("le"), R.rule(q, "gt", 30).alias("gt")]
    return _items(spark, sf_dir).select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), *tests)


@query("q_rule_approx", "SELECT l_orderkey, l_linenumber::BIGINT AS line, abs(l_discount - 0.05) <= 0.011 AS near, false AS word FROM lineitem")
def rule_approx(spark, sf_dir):
    near, word = R.rule(F.col("l_discount"), "approx:0.011", 0.05), R.rule(F.col("l_returnflag"), "approx:1", 3)
    return _items(spark, sf_dir).select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), near.alias("near"), word.alias("word"))


@query("q_rule_range", "SELECT l_orderkey, l_linenumber::BIGINT AS line, l_quantity > 10 AND l_quantity <= 20 AS te, l_quantity >= 10 AND l_quantity < 20 AS et, l_linenumber BETWEEN 3 AND 5 AND l_quantity BETWEEN 3 AND 40 AS inside FROM lineitem")
def rule_range(spark, sf_dir):
    q = F.col("l_quantity")
    cells = F.concat(F.lit("$A$1:"), F.substring(F.lit("ABCDEFG"), F.col("l_linenumber").cast("int"), F.lit(1)), q.cast("int").cast("string"))
    inside = R.rule(cells, "spreadsheet_range", ("B2:C3", "A1:E40 F1:G2"))
    return _items(spark, sf_dir).select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), R.rule(q, "range.te", (10, 20)).alias("te"), R.rule(q, "range.et", (10, 20)).alias("et"), inside.alias("inside"))


@query("q_rule_regex", "SELECT page_id, regexp_matches(url, '(?i)EXAMPLE\\.(com|org)/') AS host, regexp_matches(html, '(?s)<p>.*</p>') AS body FROM pages")
def rule_regex(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", R.rule(F.col("url"), "re.I", r"EXAMPLE\.(?P<tld>com|org)/").alias("host"), R.rule(F.col("html"), "re.S", "<p>.*</p>").alias("body"))


@query("q_rule_str_set", """SELECT event_id, event_type = 'view' AS in_order, event_type IN ('view', 'click') AS as_set FROM events""")
def rule_str_set(spark, sf_dir):
    listed = F.when(F.col("event_type") == "view", "'a, b,c'").when(F.col("event_type") == "click", '"c,a,b,a"').otherwise("x")
    return table(spark, sf_dir, "events").select("event_id", R.rule(listed, "str_list_eq", ["a", "b", "c"]).alias("in_order"), R.rule(listed, "str_set_eq", ["c", "b", "a"]).alias("as_set"))


@query("q_include_exclude", "SELECT doc_id, CASE WHEN contains(text, 'the') AND contains(text, '.') AND NOT contains(text, '|') THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM documents")
def include_exclude(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", R.includes(F.col("text"), ["the", "."], ["|"]).alias("score"))


@query("q_csv_expect_unexpect", """SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'N' AND l_linestatus = 'O') AND bool_or(l_linenumber = 1) AND NOT bool_or(l_shipmode = 'RAIL') THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM lineitem GROUP BY l_orderkey""".replace("l_shipmode = 'RAIL'", "l_returnflag = 'R'"))
def csv_expect_unexpect(spark, sf_dir):
    items = _items(spark, sf_dir)
    row = {c: F.col(c) for c in items.columns}
    test = lambda p: R.matches_record(row, p)
    return items.groupBy("l_orderkey").agg(R.expected_records(test, [{"l_returnflag": "N", "l_linestatus": "O"}, {"l_linenumber": 1}], [{"l_returnflag": "R"}]).alias("score"))


@query("q_regex_list", "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, CASE WHEN bool_or(regexp_matches(line, '^[A-Z]')) AND NOT bool_or(regexp_matches(line, '[0-9]{3}')) THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM l GROUP BY doc_id")
def regex_list(spark, sf_dir):
    score = METRICS["check_list"](F.col("text"), {"expect": ["^[A-Z]"], "unexpect": ["[0-9]{3}"]})
    return table(spark, sf_dir, "documents").select("doc_id", score.alias("score"))


@query("q_json_path", "SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE) >= 50, false) AS high FROM events")
def json_path(spark, sf_dir):
    k = R.json_at(F.col("props"), ["k"])
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), (METRICS["check_json"](F.col("props"), {"expect": [{"key": ["k"], "method": "ge", "ref": 50}]}) == 1).alias("high"))


@query("q_json_subset", "SELECT event_id, json_extract_string(props, '$.k') = (event_id % 100)::VARCHAR AS included FROM events")
def json_subset(spark, sf_dir):
    wanted = F.create_map(F.lit("k"), (F.col("event_id") % 100).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", R.subset(wanted, F.from_json("props", "map<string,string>")).alias("included"))


@query("q_eval_and_or", """WITH s AS (SELECT event_id, (event_id % 3) / 2.0::DOUBLE AS a, (user_id % 4) / 4.0::DOUBLE AS b, event_type FROM events)
SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE CASE WHEN (CASE WHEN a <> 0 THEN b ELSE a END) <> 0 THEN (CASE WHEN a <> 0 THEN b ELSE a END) ELSE CASE WHEN event_type = 'view' THEN 1.0 ELSE 0.0 END END END::DOUBLE AS score FROM s""")
def eval_and_or(spark, sf_dir):
    """``a() and b() or is_in(kind, [...])`` with the values of its operands, for each event."""
    functions = {"a": lambda: (F.col("event_id") % 3) / 2, "b": lambda: (F.col("user_id") % 4) / 4, "kind": lambda: F.col("event_type"), "is_in": lambda x, xs: x.isin(*xs).cast("double")}
    last = F.when(F.col("event_type") == "error", "FAIL").otherwise("DONE")
    return table(spark, sf_dir, "events").select("event_id", score_expression("a() and b() or is_in(kind(), ['view'])", functions, last).alias("score"))


@query("q_infeasible", "SELECT event_id, (event_type = 'error')::DOUBLE AS score FROM events")
def infeasible(spark, sf_dir):
    last = F.when(F.col("event_type") == "error", "FAIL").otherwise("DONE")
    return table(spark, sf_dir, "events").select("event_id", score_expression("infeasible(get_(env, config={}))", {}, last).alias("score"))


@query("q_validate_tasks", """SELECT doc_id AS id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'config: unknown fly' WHEN 2 THEN 'eval: syntax' ELSE 'eval: no call' END AS errors FROM documents""")
def validate(spark, sf_dir):
    """Task scripts checked against the catalogue of functions."""
    tasks = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 4 == 1, F.array(F.lit("fly(1)"))).otherwise(F.array(F.lit("launch(command='x')"), F.lit("sleep(2)"))).alias("config"), F.array(F.lit("sleep(1)")).alias("postconfig"),
        F.expr("CASE doc_id % 4 WHEN 2 THEN 'match(a' WHEN 3 THEN '1 + 1' ELSE 'float(match(read(1), 2)) and match(3, 4)' END").alias("eval"),
    )
    return validate_tasks(tasks, ["launch", "sleep"], ["match", "read"]).select("id", F.array_join("errors", "; ").alias("errors"))


# --- texts ------------------------------------------------------------------------


@query("q_line_count", "SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[.!]$'))) AS n FROM documents")
def line_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike("[.!]$"))).cast("long").alias("n"))


@query("q_text_ignore_blanks", "SELECT a.doc_id, (lower(trim(regexp_replace(a.text, '\\s+', ' ', 'g'))) = lower(trim(regexp_replace(b.text, '\\s+', ' ', 'g'))))::DOUBLE AS score FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1")
def text_ignore_blanks(spark, sf_dir):
    """Each document against the next one; what travels is the digest of the normal form, not the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(T.normal_text(F.col("text"), ignore_blanks=True, ignore_case=True).cast("binary"), 256).alias("form"))
    after = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("form").alias("after"))
    return docs.join(after, "doc_id").select("doc_id", F.col("form").eqNullSafe(F.col("after")).cast("double").alias("score"))


@query("q_indel_ratio")
def indel_ratio(spark, sf_dir):
    """The Indel likeness of each benchmark text to the next one."""
    gold = table(spark, sf_dir, "benchmark")
    after = gold.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("after"))
    return gold.join(after, "item_id").select("item_id", F.round(T.indel_ratio("text", "after"), 9).alias("ratio"))


@query("q_sequence_ratio")
def sequence_ratio(spark, sf_dir):
    """The matching-blocks ratio of the lines of each document and the next one."""
    docs = table(spark, sf_dir, "documents")
    after = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("after"))
    return docs.join(after, "doc_id").select("doc_id", F.round(T.line_ratio("text", "after"), 9).alias("ratio"))


@query("q_max_fuzzy_join")
def max_fuzzy_join(spark, sf_dir):
    """The best Indel likeness of each word of the benchmark to four fixed answers."""
    answers = [F.lit(x) for x in ("the", "thing", "reation", "and")]
    words = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.split("text", r"\s+")).alias("word")).groupBy("word").agg(F.min("item_id").alias("first_item"))
    scored = words.select("word", "first_item", F.explode(F.array(*answers)).alias("answer")).withColumn("ratio", T.indel_ratio("word", "answer"))
    return scored.groupBy("word", "first_item").agg(F.round(F.max("ratio"), 9).alias("best"))


@query("q_reference_rescale", "SELECT doc_id, round(CASE WHEN s >= 0.4::DOUBLE + 0.01::DOUBLE THEN (s - 0.4::DOUBLE) / (1 - 0.4::DOUBLE) ELSE 0 END, 6) AS score FROM (SELECT doc_id, (n_chars % 100) / 100.0::DOUBLE AS s FROM documents)")
def reference_rescale(spark, sf_dir):
    score = (F.col("n_chars") % 100) / 100
    return table(spark, sf_dir, "documents").select("doc_id", F.round(R.rescaled(score, 0.4), 6).alias("score"))


@query("q_config_default_last", "SELECT event_id, CASE WHEN event_type = 'view' THEN (event_id % 7)::VARCHAR ELSE '125' END AS volume FROM events")
def config_default_last(spark, sf_dir):
    """The last value of a key of a configuration text, or its default."""
    text = F.when(F.col("event_type") == "view", F.concat(F.lit("x=1\nvolume=9\n# volume=3\nvolume="), F.col("event_id") % 7)).otherwise("volumes=4\nx=2")
    return table(spark, sf_dir, "events").select("event_id", T.last_setting(text, "volume", "125").alias("volume"))


@query("q_pref_last_wins", """SELECT user_id, event_type AS pref, arg_max(event_id, struct_pack(t := ts, e := event_id)) AS value FROM events GROUP BY user_id, event_type""")
def pref_last_wins(spark, sf_dir):
    """Lines ``user_pref("key", value);`` of each user's file: the last one of a key counts."""
    line = F.concat(F.lit('user_pref("'), "event_type", F.lit('", '), "event_id", F.lit(");"))
    files = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", L.preference_line(line).alias("pref"))
    return files.groupBy("user_id", F.col("pref.key").alias("pref")).agg(F.max_by("pref.value", F.struct("ts", "event_id")).cast("long").alias("value"))


@query("q_mbox_dedup", "WITH m AS (SELECT conv_id, trim(text) AS mail FROM conversations WHERE turn % 3 <> 2) SELECT conv_id, count(DISTINCT mail) AS mails, md5(string_agg(DISTINCT mail, '|' ORDER BY mail)) AS digest FROM m GROUP BY conv_id")
def mbox_dedup(spark, sf_dir):
    """Mails of a folder in one text, without deleted ones, each counted once and in order."""
    status = F.when(F.col("turn") % 3 == 2, "000b").otherwise("0001")
    mail = F.concat(F.lit("From - today\nX-Mozilla-Status: "), status, F.lit("\nX-Mozilla-Keys: a\n\tb\n\n"), "text")
    folder = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.collect_list(mail), "\n").alias("mbox"))
    mails = folder.select("conv_id", mail_messages(F.col("mbox"), ignore_status=True, ignore_keys=True).alias("mails"))
    return mails.filter(F.size("mails") > 0).select("conv_id", F.size("mails").cast("long").alias("mails"), F.md5(F.array_join("mails", "|").cast("binary")).alias("digest"))


# --- tables -----------------------------------------------------------------------

_SIDES = """WITH a AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS v FROM lineitem), b AS (SELECT l_orderkey, l_linenumber, CASE WHEN (l_orderkey + l_linenumber) % 10 = 0 THEN l_extendedprice + 1 ELSE l_extendedprice + 0.0000001 END AS v FROM lineitem WHERE l_linenumber <> 5) """


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = _items(spark, sf_dir).select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("v"))
    other = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 10 == 0, F.col("v") + 1).otherwise(F.col("v") + 1e-7)
    return items, items.filter("l_linenumber <> 5").withColumn("v", other)


@query("q_sheet_data_equal", _SIDES + """SELECT l_orderkey, count(*) AS compared, count(*) FILTER (NOT same) AS differing, min(same::INT)::DOUBLE AS score
FROM (SELECT l_orderkey, coalesce(round(a.v, 4) = round(b.v, 4), false) AS same FROM a FULL JOIN b USING (l_orderkey, l_linenumber)) GROUP BY l_orderkey""")
def sheet_data_equal(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return C.positional(left, right, ["l_orderkey"], ["l_linenumber"], "v", 4)


@query("q_sheet_diff", _SIDES + """SELECT l_orderkey, l_linenumber::BIGINT AS line, CASE WHEN b.v IS NULL THEN 'removed' ELSE 'changed' END AS kind FROM a FULL JOIN b USING (l_orderkey, l_linenumber) WHERE b.v IS NULL OR round(a.v, 4) <> round(b.v, 4)""")
def sheet_diff(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return C.differences(left, right, ["l_orderkey", "l_linenumber"], "v", 4).select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), "kind")


@query("q_sheet_fuzzy", "SELECT l_orderkey, l_linenumber::BIGINT AS line, lower(l_returnflag || l_linestatus) AS cell FROM lineitem")
def sheet_fuzzy(spark, sf_dir):
    raw = F.concat(F.lit("--$"), "l_returnflag", F.lit("$-"), "l_linestatus", F.lit(" %"))
    return _items(spark, sf_dir).select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), F.regexp_replace(C.fuzzy_value(raw, drop="$", strip_left="-", strip_right=" %", ignore_case=True), "-", "").alias("cell"))


@query("q_pivot", "SELECT l_returnflag, sum(l_quantity) FILTER (l_linestatus = 'O')::DOUBLE AS o, sum(l_quantity) FILTER (l_linestatus = 'F')::DOUBLE AS f FROM lineitem GROUP BY l_returnflag")
def pivot(spark, sf_dir):
    found = _items(spark, sf_dir).groupBy("l_returnflag").pivot("l_linestatus", ["O", "F"]).agg(F.sum("l_quantity").cast("double"))
    return found.select("l_returnflag", F.col("O").alias("o"), F.col("F").alias("f"))


@query("q_cond_format_range_join", """WITH r(rule, r0, c0, r1, c1) AS (VALUES (1, 10, 1, 400, 2), (2, 300, 2, 900, 4)) SELECT l_orderkey AS "row", l_linenumber::BIGINT AS col, max(rule)::BIGINT AS style FROM lineitem, r WHERE l_orderkey BETWEEN r0 AND r1 AND l_linenumber BETWEEN c0 AND c1 GROUP BY ALL""")
def cond_format_range_join(spark, sf_dir):
    """Cells in the ranges of conditional formats; the later format wins."""
    cells = _items(spark, sf_dir).select(F.col("l_orderkey").alias("row"), F.col("l_linenumber").cast("long").alias("col"), F.lit("s").alias("sheet"))
    ranges = spark.createDataFrame([("s", 1, 10, 1, 400, 2), ("s", 2, 300, 2, 900, 4)], "sheet string, rule long, r0 long, c0 long, r1 long, c1 long")
    return C.in_ranges(cells, F.broadcast(ranges), ["sheet"]).groupBy("row", "col").agg(F.max("rule").alias("style"))


@query("q_rectangle_join", """WITH r AS (SELECT c_custkey AS rule, c_custkey * 7919 % 4000 AS r0, c_custkey * 104729 % 60 AS c0, CASE WHEN c_custkey % 50 = 0 THEN 900 ELSE c_custkey % 23 END AS h, CASE WHEN c_custkey % 40 = 0 THEN 50 ELSE c_custkey % 5 END AS w FROM customer),
c AS (SELECT l_orderkey, l_linenumber, l_orderkey % 4000 AS "row", l_partkey % 60 AS col FROM lineitem)
SELECT l_orderkey, l_linenumber::BIGINT AS line, max(rule) AS rule, count(*) AS hits FROM c JOIN r ON "row" BETWEEN r0 AND r0 + h AND col BETWEEN c0 AND c0 + w GROUP BY ALL""")
def rectangle_join(spark, sf_dir):
    """Cells of one sheet and the ranges that hold them: how many, and the last rule."""
    k = F.col("c_custkey")
    height, width = F.when(k % 50 == 0, 900).otherwise(k % 23), F.when(k % 40 == 0, 50).otherwise(k % 5)
    ranges = table(spark, sf_dir, "customer").select(F.lit("S").alias("sheet"), k.alias("rule"), (k * 7919 % 4000).alias("r0"), (k * 104729 % 60).alias("c0"), height.alias("h"), width.alias("w"))
    ranges = ranges.withColumn("r1", F.col("r0") + F.col("h")).withColumn("c1", F.col("c0") + F.col("w")).drop("h", "w")
    cells = _items(spark, sf_dir).select(F.lit("S").alias("sheet"), "l_orderkey", F.col("l_linenumber").cast("long").alias("line"), (F.col("l_orderkey") % 4000).alias("row"), (F.col("l_partkey") % 60).alias("col"))
    held = C.range_totals(cells, ranges, ["sheet"], "rule")
    return held.groupBy("l_orderkey", "line").agg(F.max("last").alias("rule"), F.sum("hits").alias("hits"))


_TURNS = """WITH w AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM conversations),
q AS (SELECT conv_id, turn - 1 AS turn, w, i FROM w) """


def _turn_words(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The words of every turn, and those of the turn after it."""
    words = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), F.posexplode(F.split("text", " ")).alias("i", "w"))
    return words, words.withColumn("turn", F.col("turn") - 1)


@query("q_positional_zip_inner", _TURNS + "SELECT conv_id, turn::BIGINT AS turn, count(*) AS compared, count(*) FILTER (w.w <> q.w) AS differing, min((w.w = q.w)::INT)::DOUBLE AS score FROM w JOIN q USING (conv_id, turn, i) GROUP BY conv_id, turn")
def positional_zip_inner(spark, sf_dir):
    """Words of each turn and the next by position, as far as both go."""
    return C.positional(*_turn_words(spark, sf_dir), ["conv_id", "turn"], ["i"], "w", longest=False)


@query("q_positional_full", _TURNS + "SELECT conv_id, turn::BIGINT AS turn, count(*) AS compared, count(*) FILTER (w.w IS DISTINCT FROM q.w) AS differing, min((w.w IS NOT DISTINCT FROM q.w)::INT)::DOUBLE AS score FROM w FULL JOIN q USING (conv_id, turn, i) GROUP BY conv_id, turn")
def positional_full(spark, sf_dir):
    return C.positional(*_turn_words(spark, sf_dir), ["conv_id", "turn"], ["i"], "w")


@query("q_set_equality", "SELECT NOT EXISTS ((SELECT lang, source FROM documents WHERE doc_id % 2 = 0 EXCEPT SELECT lang, source FROM documents WHERE doc_id % 2 = 1) UNION ALL (SELECT lang, source FROM documents WHERE doc_id % 2 = 1 EXCEPT SELECT lang, source FROM documents WHERE doc_id % 2 = 0)) AS equal")
def set_equality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return C.sets_equal(docs.filter("doc_id % 2 = 0").drop("doc_id"), docs.filter("doc_id % 2 = 1").drop("doc_id"))


@query("q_bag_equality", "SELECT NOT EXISTS ((SELECT event_type FROM events EXCEPT ALL SELECT event_type FROM events WHERE value > 0) UNION ALL (SELECT event_type FROM events WHERE value > 0 EXCEPT ALL SELECT event_type FROM events)) AS equal")
def bag_equality(spark, sf_dir):
    kinds = table(spark, sf_dir, "events")
    return C.bags_equal(kinds.select("event_type"), kinds.filter("value > 0").select("event_type"))


@query("q_subset", "SELECT source, NOT bool_or(lang NOT IN ('en', 'de', 'fr')) AS included FROM documents GROUP BY source")
def subset(spark, sf_dir):
    found = table(spark, sf_dir, "documents").groupBy("source").agg(F.collect_set("lang").alias("langs"))
    return found.select("source", (F.size(F.array_except("langs", F.array(*map(F.lit, ("en", "de", "fr"))))) == 0).alias("included"))


@query("q_unique_records", """WITH c AS (SELECT user_id AS id, count(*) AS n FROM events GROUP BY 1), k AS (SELECT DISTINCT c_custkey AS id, true AS known FROM customer)
SELECT coalesce(sum(n), 0)::BIGINT AS rows, count(n) AS ids, count(*) FILTER (n IS NULL) AS missing, count(*) FILTER (known IS NULL) AS extra, coalesce(bool_and(coalesce(n = 1, false) AND known IS NOT NULL), true)::INT::DOUBLE AS score FROM c FULL JOIN k USING (id)""")
def unique_records(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    return C.unique_and_complete(rows, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), "id")


@query("q_lists_equal_cmp", """WITH l AS (SELECT source, list(DISTINCT lang) AS a FROM documents GROUP BY source) SELECT source, len(a) = 3 AND len(list_filter(a, lambda x: NOT list_contains(['en', 'de', 'fr'], x))) = 0 AS matched FROM l""")
def lists_equal_cmp(spark, sf_dir):
    found = table(spark, sf_dir, "documents").groupBy("source").agg(F.collect_set("lang").alias("a"))
    wanted = F.array(*map(F.lit, ("EN", "DE", "FR")))
    return found.select("source", C.lists_match(F.col("a"), wanted, lambda x, y: F.lower(x) == F.lower(y)).alias("matched"))


@query("q_archive_mean_score", "SELECT l_orderkey, round(avg(CASE WHEN l_returnflag = 'A' THEN 1.0 WHEN l_returnflag = 'N' THEN 0.5 ELSE 0.0 END), 6)::DOUBLE AS score FROM lineitem GROUP BY l_orderkey")
def archive_mean_score(spark, sf_dir):
    """The mean over an archive's members of a comparator that their kind chooses; an error counts 0."""
    score = F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "N", 0.5)
    return _items(spark, sf_dir).groupBy("l_orderkey").agg(F.round(F.sum(F.coalesce(score, F.lit(0.0))) / F.count("*"), 6).alias("score"))
