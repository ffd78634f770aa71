"""Queries of workbooks, decks, actions, pictures' geometry and landed settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtrace.functions import actions as A
from loomtrace.functions import geometry as G
from loomtrace.functions import landed as L
from loomtrace.operators import decks, sheets
from loomtrace.plans.registry import query
from loomtrace.sources.tables import table


def _cells(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    base = items.select(F.col("l_orderkey").alias("pair"), F.lit("S").alias("sheet"), F.col("l_linenumber").cast("long").alias("row"), F.lit(1).alias("col"), F.col("l_returnflag").alias("text"), F.col("l_extendedprice").alias("number"))
    changed = base.withColumn("number", F.when((F.col("pair") + F.col("row")) % 9 == 0, F.col("number") + 1).otherwise(F.col("number") + 1e-7))
    return base.withColumn("side", F.lit("result")).unionByName(changed.withColumn("side", F.lit("expected")))


@query("q_workbook_rules", "SELECT l_orderkey AS pair, min(CASE WHEN (l_orderkey + l_linenumber) % 9 = 0 THEN 0 ELSE 1 END)::DOUBLE AS score FROM lineitem GROUP BY 1")
def workbook_rules(spark, sf_dir):
    """A list of rules over pairs of sheets; all of them must hold."""
    cells = _cells(spark, sf_dir)
    properties = cells.select("pair", "side", "sheet", F.lit("zoom").alias("kind"), F.lit("zoom").alias("key"), F.lit("100").alias("value")).distinct()
    return sheets.apply_rules(cells, properties, [{"type": "sheet_name"}, {"type": "sheet_data", "sheet": "S", "precision": 4}, {"type": "sheet_print", "sheet": "S", "ignore_case": True}, {"type": "zoom", "method": "ge", "ref": 100}])


@query("q_check_cell", "SELECT l_orderkey AS pair, coalesce(max(l_returnflag) FILTER (l_linenumber = 2), '') IN ('A', 'N') AS fits FROM lineitem GROUP BY 1")
def check_cell(spark, sf_dir):
    return sheets.check_cell(_cells(spark, sf_dir), "S", "A2", "re", "^[AN]$").select("pair", (F.col("score") == 1).alias("fits"))


#: Tasks of the comparison of decks for each split of the table.
DECK_TASKS = 16


@query("q_deck_compare", "SELECT l_orderkey AS pair, min(CASE WHEN l_linenumber = 4 THEN 0 ELSE 1 END)::DOUBLE AS score FROM lineitem GROUP BY 1")
def deck_compare(spark, sf_dir):
    """Slides whose shapes are alike within a tolerance; every fourth slide is widened."""
    items = table(spark, sf_dir, "lineitem")
    one = items.select(
        F.col("l_orderkey").alias("pair"), F.col("l_linenumber").alias("slide"), F.lit(0).alias("shape"), F.lit(0.0).alias("left"), F.lit(5.0).alias("top"), F.lit(100.0).alias("width"), F.lit(50.0).alias("height"), F.col("l_returnflag").alias("text"), F.lit(0).alias("paragraph"),
        F.lit(0).alias("run"), F.lit("f").alias("font"), F.lit("12").alias("size"), F.lit(None).cast("string").alias("bold"), F.lit(None).cast("string").alias("italic"), F.lit(None).cast("string").alias("strike"), F.lit(None).cast("string").alias("underline"), F.lit("000000").alias("color"), F.lit(None).cast("string").alias("alignment"),
        F.lit("text_box").alias("kind"), F.lit(None).cast("string").alias("level"), F.lit("-").alias("bullet"), F.lit(None).cast("string").alias("bullet_level"), F.lit("FFFFFF").alias("background"), F.lit(" note").alias("notes"), F.lit(0).alias("row"), F.lit(0).alias("col"),
    )
    two = one.withColumn("width", F.when(F.col("slide") == 4, 120.0).otherwise(100.4)).withColumn("bold", F.lit("false")).withColumn("alignment", F.lit("LEFT")).withColumn("text", F.concat("text", F.lit(""))).withColumn("level", F.lit("0")).withColumn("notes", F.lit("note"))
    both = one.withColumn("side", F.lit("result")).unionByName(two.withColumn("side", F.lit("expected")))
    # A row of this narrow table is some hundred bytes as a shape or a run, so each split of it is dealt to several tasks.
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), DECK_TASKS * items.rdd.getNumPartitions())
    return decks.compare_decks(both, both, both, both, partitions=partitions)


@query("q_action_forms", """SELECT event_id, CASE event_type WHEN 'view' THEN 'CLICK' WHEN 'click' THEN 'MOVE_TO,SCROLL' WHEN 'purchase' THEN 'DONE' WHEN 'error' THEN 'MOVE_TO,DRAG_TO' END AS kinds, CASE event_type WHEN 'click' THEN (-(event_id % 50))::VARCHAR WHEN 'error' THEN (event_id % 7)::VARCHAR END AS last FROM events""")
def action_forms(spark, sf_dir):
    text = F.expr("CASE event_type WHEN 'view' THEN 'left_double(1, 2)' WHEN 'click' THEN 'scroll(3,4,' || (-(event_id % 50)) || ')' WHEN 'purchase' THEN 'finish()' WHEN 'error' THEN 'drag(1,2,' || (event_id % 7) || ',9)' ELSE 'fly(1)' END")
    made = A.action_list(text)
    last = F.element_at(made, -1)["parameters"]
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.transform(made, lambda x: x["action_type"]), ",").alias("kinds"), F.coalesce(F.try_element_at(last, F.lit("dy")), F.when(F.col("event_type") == "error", F.try_element_at(last, F.lit("x")))).alias("last"))


@query("q_smart_resize", """WITH s AS (SELECT event_id, (event_id % 1900 + 10)::DOUBLE AS h, (user_id * 37 % 2500 + 30)::DOUBLE AS w FROM events), r AS (SELECT *, round_even(h / 28, 0) * 28 AS h0, round_even(w / 28, 0) * 28 AS w0 FROM s)
SELECT event_id, CASE WHEN least(h, w) < 2 OR greatest(h, w) / least(h, w) > 200 THEN NULL WHEN h0 * w0 > 1003520 THEN floor(h / sqrt(h * w / 1003520) / 28) * 28 WHEN h0 * w0 < 3136 THEN ceil(h * sqrt(3136.0::DOUBLE / (h * w)) / 28) * 28 ELSE h0 END::BIGINT AS height,
  CASE WHEN least(h, w) < 2 OR greatest(h, w) / least(h, w) > 200 THEN NULL WHEN h0 * w0 > 1003520 THEN floor(w / sqrt(h * w / 1003520) / 28) * 28 WHEN h0 * w0 < 3136 THEN ceil(w * sqrt(3136.0::DOUBLE / (h * w)) / 28) * 28 ELSE w0 END::BIGINT AS width FROM r""")
def smart_resize(spark, sf_dir):
    size = G.resized(F.col("event_id") % 1900 + 10, F.col("user_id") * 37 % 2500 + 30)
    return table(spark, sf_dir, "events").select("event_id", size["height"].alias("height"), size["width"].alias("width"))


@query("q_box_convert", """SELECT event_id, trunc(trunc((event_id % 999) / 999.0::DOUBLE * 1920) / 1920 * 999)::DOUBLE AS x, round(trunc((user_id % 999) / 999.0::DOUBLE * 1080) / 1080, 6)::DOUBLE AS y FROM events""")
def box_convert(spark, sf_dir):
    size = F.struct(F.lit(1080).alias("height"), F.lit(1920).alias("width"))
    point = F.array((F.col("event_id") % 999).cast("double"), (F.col("user_id") % 999).cast("double"))
    return table(spark, sf_dir, "events").select("event_id", G.converted(point, size, "qwen-vl", "qwen-vl")[0].alias("x"), F.round(G.converted(point, size, "qwen-vl", "rel")[1], 6).alias("y"))


@query("q_preferences", """SELECT event_id, CASE WHEN event_type = 'view' THEN 'DuckDuckGo' ELSE 'Google' END AS engine, CASE WHEN event_type = 'view' THEN 20 ELSE 16 END::BIGINT AS size, (event_type = 'view')::VARCHAR AS safe FROM events""")
def preferences(spark, sf_dir):
    text = F.when(F.col("event_type") == "view", '{"default_search_provider_data": {"template_url_data": {"short_name": "DuckDuckGo"}}, "webkit": {"webprefs": {"default_font_size": 20}}, "safebrowsing": {"enabled": true}}').otherwise("{}")
    return table(spark, sf_dir, "events").select("event_id", L.preference(text, "default_search_engine").alias("engine"), L.font_sizes(text)["default_font_size"].cast("long").alias("size"), L.safe_browsing(text).alias("safe"))


@query("q_mail_filters", """SELECT user_id, count(*) AS filters, bool_or(event_type = 'view') AS has_view FROM events GROUP BY user_id""")
def mail_filters(spark, sf_dir):
    """Filter blocks of a file read back to records."""
    block = F.concat(F.lit('name="f'), "event_id", F.lit('"\nenabled="yes"\naction="'), "event_type", F.lit('"\ncondition="AND (from,is,x)"\n'))
    files = table(spark, sf_dir, "events").groupBy("user_id").agg(F.concat(F.lit('version="9"\n'), F.array_join(F.collect_list(block), "")).alias("text"))
    found = files.withColumn("filters", L.mail_filters(F.col("text")))
    return found.select("user_id", F.size("filters").cast("long").alias("filters"), F.exists("filters", lambda f: f["action"] == "view").alias("has_view"))
