"""What tables and columns there are, and whether a release may go out: both as rows of expectations with an outcome."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

C = F.col
COLUMNS = "table_name string, column_name string, ordinal_position int, data_type string, is_nullable boolean"
# Branches that a release may be made from.
BRANCHES = r"^(?:release/.*|master|develop)$"


# --- the catalogue of tables ----------------------------------------------------------------


def columns(spark: SparkSession, tables: list[str]) -> DataFrame:
    """COLUMNS of those tables or views that Spark's catalogue has; names that it doesn't have give no rows. The size is that of the catalogue, not of the tables."""
    found = []
    for name in tables:
        if spark.catalog.tableExists(name):
            found += [(name, c.name, k, c.dataType, c.nullable) for k, c in enumerate(spark.catalog.listColumns(name), 1)]
    return spark.createDataFrame(found, COLUMNS)


def registered(spark: SparkSession, **tables: DataFrame) -> list[str]:
    """DataFrames as temporary views, so that the catalogue knows them; their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def expected_columns(known: DataFrame, expectations: DataFrame) -> DataFrame:
    """expectations (table_name, column_name or null for the table as such, data_type or null for any, present) with actual and outcome pass or fail."""
    tables = known.select(C("table_name").alias("_t")).distinct().withColumn("_has", F.lit(True))
    own = known.select(C("table_name").alias("_ct"), C("column_name").alias("_cc"), C("data_type").alias("_type"))
    rows = expectations.join(tables, C("table_name") == C("_t"), "left").join(own, (C("table_name") == C("_ct")) & (C("column_name") == C("_cc")), "left")
    there = F.when(C("column_name").isNull(), C("_has").isNotNull()).otherwise(C("_cc").isNotNull() & (C("data_type").isNull() | (C("_type") == C("data_type"))))
    actual = F.when(C("_has").isNull(), "no table").when(C("column_name").isNull(), "table").otherwise(F.coalesce("_type", F.lit("no column")))
    return rows.select("table_name", "column_name", "data_type", "present", actual.alias("actual"), F.when(there == C("present"), "pass").otherwise("fail").alias("outcome"))


def scalar_expectations(spark: SparkSession, checks: list[tuple[str, str, str, str | int]]) -> DataFrame:
    """name, actual, expected, outcome of SQL queries with one column, whose first row (null without any) is held against a value: op is =, <> or >=.

    Numbers are compared as numbers by >=, else values as text; a query that fails, as for a table that isn't there, fails the report.
    """
    out = None
    for name, sql, op, expected in checks:
        rows = spark.sql(sql)
        one = rows.limit(1).select(C(rows.columns[0]).cast("string").alias("actual")).agg(F.first("actual").alias("actual"))
        wanted = F.lit(str(expected))
        test = {"=": C("actual").eqNullSafe(wanted), "<>": ~C("actual").eqNullSafe(wanted), ">=": C("actual").try_cast("double") >= wanted.try_cast("double")}[op]
        one = one.select(F.lit(name).alias("name"), "actual", wanted.alias("expected"), F.when(F.coalesce(test, F.lit(False)), "pass").otherwise("fail").alias("outcome"))
        out = one if out is None else out.unionByName(one)
    return out


# --- versions and release gates --------------------------------------------------------------


def version_key(version: Column) -> Column:
    """struct<numbers, final, label> by which versions sort: v1.10.0 after 1.9.2, 2.0.0-rc1 before 2.0.0; null if it isn't a version.

    Numbers that are missing at the end are 0, so 1.2 and 1.2.0 are equal.
    """
    form = r"^v?([0-9]+(?:\.[0-9]+)*)(?:[-+]?([A-Za-z].*))?$"
    plain, label = F.regexp_extract(version, form, 1), F.regexp_extract(version, form, 2)
    numbers = F.transform(F.split(F.regexp_replace(plain, r"(?:\.0+)+$", ""), r"\."), lambda x: x.cast("long"))
    return F.when(plain != "", F.struct(numbers.alias("numbers"), (label == "").alias("final"), label.alias("label")))


def latest(tags: DataFrame, tag: str = "tag") -> DataFrame:
    """One row: the greatest version among tags as `latest`, null without any."""
    key = version_key(C(tag))
    return tags.filter(key.isNotNull()).agg(F.max_by(tag, F.struct(key, C(tag))).alias("latest"))


def _gate(name: str, failing: Column | None, warning: Column | None, detail: Column) -> Column:
    outcome = F.lit("pass")
    if warning is not None:
        outcome = F.when(F.coalesce(warning, F.lit(True)), "warn").otherwise(outcome)
    if failing is not None:
        outcome = F.when(F.coalesce(failing, F.lit(True)), "fail").otherwise(outcome)
    return F.struct(F.lit(name).alias("gate"), outcome.alias("outcome"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail"))


def release_gates(releases: DataFrame, changes: DataFrame, tracked: DataFrame, sensitive: DataFrame, tags: DataFrame, folders: DataFrame, wanted: list[str] = ("docs",)) -> DataFrame:
    """release, gate, outcome, detail: five gates for each release (release, branch, version).

    branch: a known one, else a warning. clean: no uncommitted change (release, path). secrets: no tracked path (release, path) is a sensitive one (path). folders: each of
    `wanted` is there (release, path), else a warning. version: it is one, and greater than the latest of the release's tags (release, tag); without tags any is.
    Each table meets the releases by one aggregated row, whatever its size.
    """
    key = lambda name: C("release").alias(f"_{name}")
    dirty = changes.groupBy(key("d")).agg(F.count("*").alias("dirty"))
    leaked = tracked.join(sensitive.select("path").distinct(), "path", "left_semi").groupBy(key("s")).agg(F.count("*").alias("leaked"), F.min("path").alias("first_leak"))
    # one hot folder name is counted once a release
    there = folders.filter(C("path").isin(*wanted)).groupBy(key("f")).agg(F.count_distinct("path").alias("there"))
    newest = tags.withColumn("_key", version_key(C("tag"))).filter(C("_key").isNotNull()).groupBy(key("t")).agg(F.max_by("tag", F.struct("_key", "tag")).alias("latest"), F.max("_key").alias("latest_key"))
    parts = [(dirty, "_d"), (leaked, "_s"), (there, "_f"), (newest, "_t")]
    rows = reduce(lambda out, x: out.join(x[0], C("release") == C(x[1]), "left"), parts, releases)
    own = version_key(C("version"))
    gates = F.array(
        _gate("branch", None, ~C("branch").rlike(BRANCHES), C("branch")),
        _gate("clean", F.coalesce(C("dirty"), F.lit(0)) > 0, None, F.coalesce(C("dirty"), F.lit(0))),
        _gate("secrets", F.coalesce(C("leaked"), F.lit(0)) > 0, None, C("first_leak")),
        _gate("folders", None, F.coalesce(C("there"), F.lit(0)) < len(wanted), F.coalesce(C("there"), F.lit(0))),
        _gate("version", own.isNull() | F.coalesce(own <= C("latest_key"), F.lit(False)), None, C("latest")),
    )
    return rows.select("release", F.explode(gates).alias("g")).select("release", "g.gate", "g.outcome", "g.detail")
