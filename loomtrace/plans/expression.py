"""Evaluator expressions compiled to Columns, and static checks of task scripts.

An expression composes named functions with ``and``, ``or``, ``not``, comparison and
arithmetic. It is parsed, never executed: each name is looked up in a table of
functions that build Columns, and anything else is refused. A getter of the language
takes ``env`` first: the landed state of an attempt (``plans.getters``). Metrics over
files take their bytes, the others get a file's text.
"""

from __future__ import annotations

import ast
import operator
from collections.abc import Callable, Mapping
from types import MappingProxyType

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from loomtrace.functions.rules import truthy_and, truthy_or
from loomtrace.plans.getters import GETTERS, Landed, LandedFile

#: The marker of tasks that cannot be done: they succeed if the last action gives up.
INFEASIBLE = "infeasible"

_BINARY = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv}
_COMPARE = {ast.Eq: operator.eq, ast.NotEq: operator.ne, ast.Lt: operator.lt, ast.LtE: operator.le, ast.Gt: operator.gt, ast.GtE: operator.ge}


class ExpressionError(ValueError):
    """The text is not an expression of the language."""


def compile_expression(text: str, functions: Mapping[str, Callable[..., object]], env: Landed | None = None) -> Column:
    """The Column that an expression stands for; a null result scores 0. ``env`` is the landed state that getters read."""
    try:
        body = ast.parse(text.strip(), mode="eval").body
    except SyntaxError as error:
        raise ExpressionError(f"not an expression: {text}") from error
    value = _build(body, {**GETTERS, **functions} if env is not None else functions, {"env": env} if env is not None else {})
    return F.coalesce(_column(value).cast("double"), F.lit(0.0))


def score_expression(text: str, functions: Mapping[str, Callable[..., object]], last_action: Column, env: Landed | None = None) -> Column:
    """The score of a task: an expression that names infeasibility asks for the last action ``FAIL``, any other loses by it."""
    failed = F.coalesce(last_action == "FAIL", F.lit(False))
    if INFEASIBLE in text:
        return failed.cast("double")
    return F.when(failed, 0.0).otherwise(compile_expression(text, functions, env))


def score_attempts(attempts: DataFrame, evaluators: Mapping[str, str], functions: Mapping[str, Callable[..., object]], env: Landed | None = None) -> DataFrame:
    """(attempt, task, score, error) of attempts (attempt, task, last_action, texts, files) of tasks whose evaluators are given.

    Tasks with the same text share one branch of the plan, which reads the rows of its
    tasks only (a partition each where attempts are laid out by task). A text that is no
    expression of the language scores 0 and says why; attempts of unknown tasks too.
    """
    env = env or Landed()
    tasks: dict[str, list[str]] = {}
    for task, text in evaluators.items():
        tasks.setdefault(text, []).append(task)
    columns = lambda score, error: [F.col("attempt"), F.col("task"), score.alias("score"), F.lit(error).cast("string").alias("error")]
    known = F.coalesce(F.col("task").isin(list(evaluators)), F.lit(False))
    scored = attempts.filter(~known).select(*columns(F.lit(0.0), "no such task"))
    for text, names in sorted(tasks.items()):
        try:
            score, error = score_expression(text, functions, F.col("last_action"), env), None
        except ExpressionError as reason:
            score, error = F.lit(0.0), str(reason)
        scored = scored.union(attempts.filter(F.col("task").isin(names)).select(*columns(score, error)))
    return scored


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _argument(function: Callable[..., object], value):
    """A landed file as what the function takes of it."""
    if not isinstance(value, LandedFile) or getattr(function, "takes_files", False):
        return value
    return value.text


def _build(node: ast.AST, functions: Mapping[str, Callable[..., object]], scope: Mapping[str, object] = MappingProxyType({})):
    again = lambda n: _build(n, functions, scope)
    number = lambda n: _column(again(n)).cast("double")
    if isinstance(node, ast.Constant):
        return node.value
    if isinstance(node, ast.List | ast.Tuple):
        return [again(n) for n in node.elts]
    if isinstance(node, ast.Dict):
        return {again(k): again(v) for k, v in zip(node.keys, node.values, strict=True)}
    if isinstance(node, ast.BoolOp):
        join = truthy_and if isinstance(node.op, ast.And) else truthy_or
        value = number(node.values[0])
        for n in node.values[1:]:
            value = join(value, number(n))
        return value
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.Not):
        return (number(node.operand) == 0).cast("double")
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
        return -again(node.operand)
    if isinstance(node, ast.BinOp) and type(node.op) in _BINARY:
        return _BINARY[type(node.op)](_column(again(node.left)), _column(again(node.right)))
    if isinstance(node, ast.Compare) and len(node.ops) == 1 and type(node.ops[0]) in _COMPARE:
        return _COMPARE[type(node.ops[0])](_column(again(node.left)), _column(again(node.comparators[0])))
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Name):
        if node.func.id not in functions:
            raise ExpressionError(f"no such function: {node.func.id}")
        function = functions[node.func.id]
        take = lambda n: _argument(function, again(n))
        try:
            return function(*map(take, node.args), **{k.arg: take(k.value) for k in node.keywords})
        except (TypeError, KeyError, ValueError, AttributeError) as error:  # wrong arguments
            raise ExpressionError(f"{node.func.id}: {error}") from error
    if isinstance(node, ast.Name) and node.id in scope:
        return scope[node.id]
    raise ExpressionError(f"not allowed: {ast.dump(node)[:80]}")


def called_names(text: str) -> list[str] | None:
    """The functions that an expression calls by name, in order; null if it is not an expression."""
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except (SyntaxError, ValueError):
        return None
    return [n.func.id for n in ast.walk(tree) if isinstance(n, ast.Call) and isinstance(n.func, ast.Name)]


@F.pandas_udf(ArrayType(StringType()))
def calls(text: pd.Series) -> pd.Series:
    """``called_names`` of a column."""
    return text.map(lambda x: None if x is None else called_names(x))


#: Plain functions that an expression may call besides the catalogue.
BUILT_IN = ("abs", "all", "any", "bool", "float", "int", "len", "max", "min", "round", "str", "sum")


def validate_tasks(tasks: DataFrame, setup: list[str], scoring: list[str]) -> DataFrame:
    """(id, errors) of tasks (id, config, postconfig: arrays of scripts; eval): an empty array of errors is a valid task.

    Every script must be an expression; configuration may call ``setup`` functions, the
    evaluator ``scoring`` ones and BUILT_IN, and it must call at least one.
    """
    scripts = F.flatten(F.array(
        F.transform(F.coalesce("config", F.array().cast("array<string>")), lambda x: F.struct(F.lit("config").alias("kind"), x.alias("script"))),
        F.transform(F.coalesce("postconfig", F.array().cast("array<string>")), lambda x: F.struct(F.lit("postconfig").alias("kind"), x.alias("script"))),
        F.array(F.struct(F.lit("eval").alias("kind"), F.coalesce("eval", F.lit("")).alias("script"))),
    ))
    rows = tasks.select("id", F.posexplode(scripts).alias("at", "s")).select("id", "at", "s.kind", "s.script").withColumn("names", calls("script"))
    names = lambda xs: F.array(*map(F.lit, xs)) if xs else F.array().cast("array<string>")
    unknown = F.array_except("names", F.when(F.col("kind") == "eval", names([*scoring, *BUILT_IN])).otherwise(names(setup)))
    error = (
        F.when(F.col("names").isNull(), F.concat("kind", F.lit(": syntax")))
        .when(F.size(unknown) > 0, F.concat("kind", F.lit(": unknown "), F.array_join(F.array_sort(unknown), " ")))
        .when((F.col("kind") == "eval") & (F.size("names") == 0), "eval: no call")
    )
    found = rows.withColumn("error", error).groupBy("id").agg(F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("at", "error")))).alias("e"))
    return found.select("id", F.transform("e", lambda x: x["error"]).alias("errors"))
