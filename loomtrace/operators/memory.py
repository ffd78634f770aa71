"""Experience memory, results and catalogues: keyed last-wins views, classes and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, with ``first_seen``: where the key was first put."""
    columns = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("row"), F.min(F.struct(*order)).alias("first_seen"))
    return picked.select(*keys, *[F.col(f"row.{c}").alias(c) for c in columns], "first_seen")


def memory_class(executable: Column, solvable: Column) -> Column:
    """solvable, executable or failed; an unknown flag counts as false."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(yes(solvable), "solvable").when(yes(executable), "executable").otherwise("failed")


def result_class(score: Column, error: Column) -> Column:
    """errored, solvable (score above 0) or unsolvable."""
    return F.when(error.isNotNull(), "errored").when(score > 0, "solvable").otherwise("unsolvable")


def last_n(rows: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The last n rows of each group."""
    window = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("place", F.row_number().over(window).cast("long")).filter(F.col("place") <= n)


def first_n(rows: DataFrame, by: list[str], order: list[str], n: int, most: int = 0) -> DataFrame:
    """The first n rows of each group and at most ``most`` of all; 0 stands for no limit."""
    if n:
        rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).filter(F.col("place") <= n).drop("place")
    return rows.orderBy(*by, *order).limit(most) if most else rows


def failure_keywords(rows: DataFrame, reasons: str, n: int = 10) -> DataFrame:
    """(keyword, n): the most frequent 60 characters after ``error=`` in arrays of reasons; ties by keyword."""
    words = rows.select(F.explode(reasons).alias("reason")).filter(F.col("reason").contains("error="))
    keyword = F.substring(F.element_at(F.split("reason", "error="), -1), 1, 60)
    return words.groupBy(keyword.alias("keyword")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "keyword").limit(n)


def memory_stats(rows: DataFrame) -> DataFrame:
    """(total, executable, solvable) counts."""
    return rows.agg(F.count("*").alias("total"), F.count_if("executable").alias("executable"), F.count_if("solvable").alias("solvable"))


def run_summary(results: DataFrame) -> DataFrame:
    """(avg_score, done, errored): the mean excludes rows with an error; 0 without any other."""
    fine = F.col("error").isNull()
    return results.agg(F.coalesce(F.avg(F.when(fine, F.col("score"))), F.lit(0.0)).alias("avg_score"), F.count_if("done").alias("done"), F.count_if(~fine).alias("errored"))


def pending(tasks: DataFrame, memory: DataFrame, key: str) -> DataFrame:
    """Tasks that have no tested row in ``memory``: a row whose solvable flag is unknown is tried again."""
    return tasks.join(memory.filter("solvable is not null").select(key), key, "left_anti")


def manifest(rows: DataFrame, domain: str, key: str) -> DataFrame:
    """(domain, id): each id of each domain once. A manifest is kept as rows, so that no domain has to fit in one."""
    return rows.select(domain, F.col(key).alias("id")).distinct()


def merge_manifests(old: DataFrame, new: DataFrame) -> DataFrame:
    """The union of two manifests."""
    return old.unionByName(new).distinct()


def write_manifest(ids: DataFrame, domain: str, path: str) -> None:
    """A manifest as JSON lines in a folder for each domain, sorted by id from file to file."""
    ids.repartitionByRange(domain, "id").sortWithinPartitions(domain, "id").write.mode("overwrite").partitionBy(domain).json(path)


def task_text(instruction: Column, evaluator: Column) -> Column:
    """What of a task is embedded: its instruction and, if there is one, its verifier."""
    rule = F.trim(F.coalesce(evaluator, F.lit("")))
    return F.concat(F.trim(F.coalesce(instruction, F.lit(""))), F.when(rule != "", F.concat(F.lit("\n\nVERIFIER: "), rule)).otherwise(""))


def timing_summary(timings: DataFrame) -> DataFrame:
    """Sums and means of timing rows, and the speedup that perfect parallel running would give."""
    steps = F.aggregate("step_times", F.lit(0.0), lambda a, x: a + x)
    rows = timings.withColumn("in_steps", steps).withColumn("n_steps", F.size("step_times"))
    return rows.agg(
        F.count("*").alias("tasks"), F.count_if("success").alias("succeeded"), F.avg("reset_time").alias("avg_reset"),
        (F.sum("in_steps") / F.sum("n_steps")).alias("avg_step"), F.avg("finish_time").alias("avg_finish"), F.avg("total_time").alias("avg_total"),
        (F.sum("total_time") / F.max("total_time")).alias("potential_speedup"),
    )
