"""Substitution rules as a table: read from JSON, joined to the rows of their locale and applied in order. Patterns are in Java's dialect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

C = F.col
RULES = "locale string, family string, seq int, pattern string, replacement string, include string, exclude string"
#: Fixed value: the shape of a file of mined rules.
MINED = (
    "struct<per_locale: map<string, struct<rules: array<struct<pattern: string, replace: string, guard: struct<include: string, exclude: string>>>, "
    "review_only: array<struct<wrong: string, right: string, source_term: string, why_not_mechanical: string>>>>>"
)
#: Rules up to this number are broadcast, a locale's in one row; beyond, the join shuffles.
BROADCAST_RULES = 50_000


def java_replacement(text: Column) -> Column:
    r"""A replacement with \1 as one with $1; a dollar sign stays one."""
    return F.regexp_replace(F.replace(text, F.lit("$"), F.lit("\\$")), r"\\(\d)", r"\$$1")


def _documents(documents: DataFrame, text: str) -> DataFrame:
    doc = F.from_json(text, MINED, {"mode": "FAILFAST"})
    return documents.select(F.explode(doc["per_locale"]).alias("locale", "d"))


def mined_rules(documents: DataFrame, text: str = "text", family: str = "mined") -> DataFrame:
    """Rules of mined files (one JSON document a row), in the order of the file; an empty table of files gives none, a broken file fails the query."""
    rows = _documents(documents, text).select("locale", F.posexplode("d.rules").alias("seq", "r"))
    return rows.select("locale", F.lit(family).alias("family"), "seq", "r.pattern", C("r.replace").alias("replacement"), "r.guard.include", "r.guard.exclude")


def review_only(documents: DataFrame, text: str = "text") -> DataFrame:
    """locale, wrong, right, source_term, reason of known problems that are left to a reader."""
    rows = _documents(documents, text).select("locale", F.explode("d.review_only").alias("r"))
    return rows.select("locale", "r.wrong", "r.right", "r.source_term", C("r.why_not_mechanical").alias("reason"))


def read_mined(spark: SparkSession, path: str) -> DataFrame:
    """The text of a mined file; a missing one is an empty table."""
    from ..sources.shared import Folder

    folder, _, name = path.rpartition("/")
    if not Folder(spark, folder).has(name):
        return spark.createDataFrame([], "text string")
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "text")


def in_order(*tables: DataFrame) -> DataFrame:
    """Tables of rules as one, those of the first before those of the second."""
    out = None
    for k, t in enumerate(tables):
        one = t.select(*[C(c.split()[0]) for c in RULES.split(", ")], F.lit(k).alias("rank"))
        out = one if out is None else out.unionByName(one)
    return out


def with_rules(rows: DataFrame, rules: DataFrame, locale: str = "locale") -> DataFrame:
    """rows with `_rules`: their locale's rules as an array in order, null without any."""
    one = F.struct("rank", "seq", "pattern", java_replacement(C("replacement")).alias("replacement"), "include", "exclude", "family")
    own = rules.groupBy(C("locale").alias("_l")).agg(F.array_sort(F.collect_list(one)).alias("_rules"))
    if rules.count() <= BROADCAST_RULES:
        own = F.broadcast(own)
    return rows.join(own, C(locale) == C("_l"), "left").drop("_l")


def folded(text: Column, msgid: Column, rules: Column) -> Column:
    """The rules of an array one after the other, each where msgid matches its include and not its exclude, without regard to case."""

    def fits(pattern: Column, otherwise: bool) -> Column:
        return F.when(pattern.isNull() | (pattern == ""), F.lit(otherwise)).otherwise(F.regexp_like(msgid, F.concat(F.lit("(?i)"), pattern)))

    def step(now: Column, r: Column) -> Column:
        return F.when(fits(r["include"], True) & ~fits(r["exclude"], False), F.regexp_replace(now, r["pattern"], r["replacement"])).otherwise(now)

    return F.coalesce(F.aggregate(rules, text, step), text)


def corrected(rows: DataFrame, rules: DataFrame, src: str = "src", dst: str = "dst", locale: str = "locale", plural: str | None = None) -> DataFrame:
    """rows with new_dst and changed. Texts equal to their source or its plural, but for white space at the ends, are fallbacks and stay as they are."""
    from ..functions.text import strip

    held = with_rules(rows, rules, locale)
    echo = strip(C(dst)) == strip(C(src))
    if plural:
        echo = echo | (strip(C(dst)) == strip(F.coalesce(C(plural), F.lit(""))))
    new = F.when(echo, C(dst)).otherwise(folded(C(dst), C(src), C("_rules")))
    return held.withColumn("new_dst", new).withColumn("changed", ~C("new_dst").eqNullSafe(C(dst))).drop("_rules")
