"""Expectations, freshness and log summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

C = F.col


def expectations(checks: list[tuple[str, DataFrame, str, int]]) -> DataFrame:
    """name, actual, expected, outcome for counts: op is = or >=. One row for each check, whatever the tables' sizes."""
    out = None
    for name, df, op, expected in checks:
        actual = F.count("*").cast("long")
        ok = (C("actual") >= expected) if op == ">=" else (C("actual") == expected)
        one = df.agg(actual.alias("actual")).select(F.lit(name).alias("name"), "actual", F.lit(expected).cast("long").alias("expected"), F.when(ok, "pass").otherwise("fail").alias("outcome"))
        out = one if out is None else out.unionByName(one)
    return out


def outcomes(report: DataFrame) -> DataFrame:
    return report.groupBy("outcome").agg(F.count("*").alias("n"))


def fresh(rows: DataFrame, at: str, today: Column, within: int, warn: int) -> DataFrame:
    """Adds age in days and state: fresh, aging or stale."""
    age = F.datediff(today, F.to_date(at))
    return rows.withColumn("age", age).withColumn("state", F.when(age < within, "fresh").when(age < warn, "aging").otherwise("stale"))


def tail(lines: DataFrame, path: str, line: str, n: int = 40) -> DataFrame:
    """The last n lines of each file."""
    w = Window.partitionBy(path).orderBy(F.desc(line))
    return lines.withColumn("_n", F.row_number().over(w)).filter(C("_n") <= n).drop("_n")


def plain(text: Column) -> Column:
    """Without terminal colours."""
    return F.regexp_replace(text, r"\x1b\[[0-9;]*m", "")


def log_totals(lines: DataFrame, path: str, text: str, names: tuple[str, ...] = ("passed", "failed", "skipped", "flaky")) -> DataFrame:
    """Per file the sums of lines such as `12 passed`."""
    one = lambda n: F.coalesce(F.sum(F.nullif(F.regexp_extract(plain(C(text)), rf"(?:^|[^0-9])([0-9]+) {n}(?:[^a-z]|$)", 1), F.lit("")).cast("long")), F.lit(0)).alias(n)
    return lines.groupBy(path).agg(*[one(n) for n in names])
