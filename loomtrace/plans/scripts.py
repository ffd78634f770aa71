"""Setup scripts of tasks as rows, and the catalogue of functions that tasks may call.

A setup script is one call with literal arguments. What machines do with it is not data
processing; here scripts are read, checked against the functions there are and laid out
as steps, in the order in which a task asks for them.
"""

from __future__ import annotations

import ast
import inspect
import json
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from loomtrace.functions.file_metrics import EVALUATOR
from loomtrace.functions.times import to_browser_time
from loomtrace.plans.getters import GETTERS

# Setup functions by name, their needed and their other arguments; ``*`` stands for any.
SETUP_FUNCTIONS: Mapping[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "_download_setup": (("files",), ()),
    "_upload_file_setup": (("files",), ()),
    "_change_wallpaper_setup": (("path",), ()),
    "_tidy_desktop_setup": ((), ("*",)),
    "_open_setup": (("path",), ()),
    "_launch_setup": (("command",), ("shell",)),
    "_execute_setup": (("command",), ("stdout", "stderr", "shell", "until")),
    "_command_setup": (("command",), ("*",)),
    "_execute_with_verification_setup": (("command",), ("verification", "max_wait_time", "check_interval", "shell")),
    "_sleep_setup": (("seconds",), ()),
    "_act_setup": (("action_seq",), ()),
    "_replay_setup": (("trajectory",), ()),
    "_activate_window_setup": (("window_name",), ("strict", "by_class")),
    "_close_window_setup": (("window_name",), ("strict", "by_class")),
    "_proxy_setup": ((), ("client_password",)),
    "_chrome_open_tabs_setup": (("urls_to_open",), ()),
    "_chrome_close_tabs_setup": (("urls_to_close",), ()),
    "_googledrive_setup": ((), ("*",)),
    "_login_setup": ((), ("*",)),
    "_update_browse_history_setup": ((), ("*",)),
}

STEP = StructType([StructField("name", StringType()), StructField("arguments", MapType(StringType(), StringType())), StructField("error", StringType())])


def read_step(script: str) -> tuple[str | None, dict[str, str], str | None]:
    """(name, arguments as JSON texts, error) of a setup script."""
    try:
        call = ast.parse(script.strip(), mode="eval").body
    except (SyntaxError, ValueError):
        return None, {}, "syntax"
    if not isinstance(call, ast.Call) or not isinstance(call.func, ast.Name):
        return None, {}, "no call"
    name = call.func.id
    if name not in SETUP_FUNCTIONS:
        return name, {}, "no such function"
    needed, other = SETUP_FUNCTIONS[name]
    try:
        given = dict(zip((*needed, *other), map(ast.literal_eval, call.args), strict=False)) | {k.arg: ast.literal_eval(k.value) for k in call.keywords}
    except ValueError:
        return name, {}, "no literal"
    shown = {str(k): json.dumps(v, ensure_ascii=False) for k, v in given.items()}
    missing = [k for k in needed if k not in given]
    unknown = [k for k in given if k not in needed and k not in other] if "*" not in other else []
    error = f"missing {missing[0]}" if missing else f"unknown {unknown[0]}" if unknown else "too many arguments" if len(call.args) > len(needed) + len(other) else None
    return name, shown, error


@F.pandas_udf(ArrayType(STEP))
def _steps(scripts: pd.Series) -> pd.Series:
    return scripts.map(lambda xs: None if xs is None else [dict(zip(("name", "arguments", "error"), read_step(x or ""), strict=True)) for x in xs])


def setup_steps(tasks: DataFrame) -> DataFrame:
    """(id, phase, at, name, arguments, error): the steps of tasks (id, config, postconfig: arrays of scripts), before and after an attempt."""
    phases = []
    for phase in ("config", "postconfig"):
        rows = tasks.select("id", F.lit(phase).alias("phase"), F.posexplode(_steps(F.coalesce(phase, F.array().cast("array<string>")))).alias("at", "s"))
        phases.append(rows.select("id", "phase", F.col("at").cast("long").alias("at"), "s.name", "s.arguments", "s.error"))
    return phases[0].union(phases[1])


def argument(name: str) -> Column:
    """An argument of a step as JSON text; null where it is not given."""
    return F.try_element_at("arguments", F.lit(name))


def waits(steps: DataFrame) -> DataFrame:
    """(id, phase, seconds): how long the steps of a phase only wait."""
    slept = F.when(F.col("name") == "_sleep_setup", argument("seconds").try_cast("double")).otherwise(0.0)
    return steps.groupBy("id", "phase").agg(F.sum(F.coalesce(slept, F.lit(0.0))).alias("seconds"))


def downloads(steps: DataFrame) -> DataFrame:
    """(id, phase, at, url, path): the files that steps fetch."""
    files = F.from_json(argument("files"), "array<struct<url:string,path:string>>")
    return steps.filter("name = '_download_setup'").select("id", "phase", "at", F.explode(files).alias("f")).select("id", "phase", "at", "f.url", "f.path")


def opened_tabs(steps: DataFrame) -> DataFrame:
    """(id, phase, tab, url): the tabs that steps open, in order."""
    urls = F.from_json(argument("urls_to_open"), "array<string>")
    return steps.filter("name = '_chrome_open_tabs_setup'").select("id", "phase", F.posexplode(urls).alias("tab", "url"))


def history_rows(steps: DataFrame, now: Column) -> DataFrame:
    """(id, url, title, visited): the visits that steps put into a browser's history, as microseconds since 1601."""
    visits = F.from_json(argument("history"), "array<struct<url:string,title:string,visit_time_from_now_in_seconds:long>>")
    rows = steps.filter("name = '_update_browse_history_setup'").select("id", F.explode(visits).alias("v"))
    back = F.make_dt_interval(secs=F.col("v.visit_time_from_now_in_seconds").cast("decimal(18,6)"))
    return rows.select("id", "v.url", "v.title", to_browser_time(now - back).alias("visited"))


# --- the catalogue ----------------------------------------------------------------


def _described(kind: str, name: str, function) -> tuple[str, str, str, str]:
    try:
        signature = str(inspect.signature(function))
    except (TypeError, ValueError):
        signature = "(...)"
    return kind, name, f"{name}{signature}", (inspect.getdoc(function) or "").split("\n")[0]


def function_catalog(spark: SparkSession) -> DataFrame:
    """(kind, name, signature, doc) of all setup functions, getters and metrics, of which there are a few hundred."""
    rows = [("setup", n, f"{n}({', '.join((*needed, *(o if o == '*' else f'{o}=None' for o in other)))})", "") for n, (needed, other) in SETUP_FUNCTIONS.items()]
    rows += [_described("getter", n, f) for n, f in GETTERS.items()] + [_described("metric", n, f) for n, f in EVALUATOR.items()]
    return spark.createDataFrame(sorted(rows), "kind string, name string, signature string, doc string")


def formatted_catalog(catalog: DataFrame) -> DataFrame:
    """(kind, text): a line ``- signature: doc`` for each function of a kind, by name."""
    lines = F.array_sort(F.collect_list(F.struct("name", F.concat(F.lit("- "), "signature", F.lit(": "), "doc").alias("line"))))
    return catalog.groupBy("kind").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("text"))
