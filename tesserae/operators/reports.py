"""Findings as a report: lines of fixed width, the first examples of each class, totals and an exit code. All of it stays a DataFrame until it is shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import kept

C = F.col


def padded(value: Column, width: int, right: bool = False) -> Column:
    """A value filled up with spaces to a width; longer ones stay whole."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    filled = F.lpad(text, width, " ") if right else F.rpad(text, width, " ")
    return F.when(F.length(text) < width, filled).otherwise(text)


def table_lines(rows: DataFrame, columns: list[tuple[str, int]], order: list[str | Column]) -> DataFrame:
    """line, in order: a row for each of rows, columns (name, width) set apart by ` | `; a negative width sets to the right."""
    cells = [padded(C(name), abs(width), width < 0) for name, width in columns]
    return rows.orderBy(*order).select(F.rtrim(F.concat_ws(" | ", *cells)).alias("line"))


def heading(columns: list[tuple[str, int]]) -> list[str]:
    """The two lines above such a table."""
    names = " | ".join(name.rjust(-w) if w < 0 else name.ljust(w) for name, w in columns).rstrip()
    return [names, "-|-".join("-" * abs(w) for _, w in columns)]


def examples(found: DataFrame, bucket: list[str], order: str, n: int = 5, width: int = 88) -> DataFrame:
    """The first n rows of each bucket with src and dst cut to a width, their place, and how many rows the bucket has; all rows for n = 0.

    Spark keeps n rows of a bucket in each task before they meet, so a bucket may hold most of the rows. Findings are made once: they are written, cut, and read for both.
    """
    found = kept(found.withColumns({c: F.left(c, F.lit(width)) for c in ("src", "dst") if c in found.columns}))
    own = found.withColumn("place", F.row_number().over(Window.partitionBy(*bucket).orderBy(order)))
    own = own.filter(C("place") <= n) if n else own
    sizes = found.groupBy(*[C(b).alias(f"_{b}") for b in bucket]).agg(F.count("*").alias("of"))
    return own.join(sizes, [C(b).eqNullSafe(C(f"_{b}")) for b in bucket]).drop(*[f"_{b}" for b in bucket])


def class_totals(found: DataFrame) -> DataFrame:
    """cls, hard, n and line of each class that has findings, hard ones unmarked and soft ones marked, by descending number and then by name."""
    counts = found.groupBy("cls", "hard").agg(F.count("*").alias("n"))
    line = F.concat(F.lit("    "), padded(C("cls"), 20), F.lit(" "), padded(C("n"), 5, right=True), F.when(C("hard"), "").otherwise("  (soft)"))
    return counts.withColumn("line", line).orderBy(F.desc("n"), "cls")


def exit_code(read: DataFrame, found: DataFrame, errors: DataFrame | None = None, hard: str = "hard") -> int:
    """2 if nothing was read or a file had an error, else 1 with a hard finding, else 0."""
    if read.isEmpty() or (errors is not None and not errors.isEmpty()):
        return 2
    return int(not found.filter(C(hard)).isEmpty())
