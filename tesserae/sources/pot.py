"""Template catalogues (.pot): merged from several sources, written in order through Spark's writer, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import escape_po

C = F.col


def template(*sources: DataFrame) -> DataFrame:
    """rank, pos, msgid, msgid_plural, locations: records (msgid, msgid_plural, path, line) of ordered sources, one for each msgid, where the first of them stands.

    A record gets all places of its msgid, in order, and the first plural there is. Records without a msgid are left out.
    """
    rows = None
    for rank, s in enumerate(sources):
        one = s.filter(F.coalesce(C("msgid"), F.lit("")) != "").select("msgid", C("msgid_plural") if "msgid_plural" in s.columns else F.lit(None).cast("string").alias("msgid_plural"), F.struct(F.lit(rank).alias("rank"), C("path").alias("path"), C("line").cast("long").alias("line")).alias("at"))
        rows = one if rows is None else rows.unionByName(one)
    # places of a text that stands everywhere are one row for each place, as in the file itself
    merged = rows.groupBy("msgid").agg(F.min("at").alias("at"), F.min_by("msgid_plural", F.when(C("msgid_plural").isNotNull(), C("at"))).alias("msgid_plural"), F.array_sort(F.collect_set("at")).alias("_all"))
    return merged.select("at", "msgid", "msgid_plural", F.transform("_all", lambda x: F.concat_ws(":", x["path"], x["line"].cast("string"))).alias("locations"))


def quoted(word: str, value: Column) -> Column:
    """A keyword and its string; with line feeds inside, one line for each."""
    pieces = F.filter(F.split(F.regexp_replace(value, "\n(?=.)", "\n\u0001"), "\u0001"), lambda x: x != "")
    many = F.concat(F.lit(f'{word} ""\n'), F.array_join(F.transform(pieces, lambda p: F.concat(F.lit('"'), escape_po(p), F.lit('"'))), "\n"))
    return F.when(F.size(pieces) > 1, many).otherwise(F.concat(F.lit(f'{word} "'), escape_po(value), F.lit('"')))


def record(locations: Column, msgid: Column, msgid_plural: Column) -> Column:
    """The text of a template's record, with the line feeds behind it."""
    places = F.array_join(F.transform(locations, lambda x: F.concat(F.lit("#: "), x, F.lit("\n"))), "")
    texts = F.when(msgid_plural.isNull() | (msgid_plural == ""), F.concat(quoted("msgid", msgid), F.lit('\nmsgstr ""\n\n'))).otherwise(
        F.concat(quoted("msgid", msgid), F.lit("\n"), quoted("msgid_plural", msgid_plural), F.lit('\nmsgstr[0] ""\nmsgstr[1] ""\n\n')))
    return F.concat(places, texts)


def license_head(package: str, year: int, holder: str) -> str:
    """The comments above a template's header."""
    return f"# {package} translation template.\n# Copyright (C) {year} {holder}\n# This file is distributed under the same license as the {package} package.\n#\n#, fuzzy\n"


def write_template(records: DataFrame, folder: str, head: str, fields: list[tuple[str, str]], parts: int | None = None, most: int = 20000) -> None:
    """Template records as part files of a folder, their names in the order of the records, which are dealt by ranges of `at`.

    A file has at most `most` records, as readers hold a file's text whole. The head and the header's fields open the first part. Spark's own commit moves all parts into place at the end, in any store; an existing folder is an error.
    """
    spark = records.sparkSession
    lines = "".join(f'"{k}: {v}\\n"\n' for k, v in fields)
    header = spark.createDataFrame([(f'{head}msgid ""\nmsgstr ""\n{lines}\n',)], "text string").select(F.struct(F.lit(-1).alias("rank"), F.lit("").alias("path"), F.lit(0).cast("long").alias("line")).alias("at"), F.lit("").alias("msgid"), "text")
    body = records.select("at", "msgid", record(C("locations"), C("msgid"), C("msgid_plural")).alias("text"))
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = header.unionByName(body).repartitionByRange(n, "at", "msgid").sortWithinPartitions("at", "msgid")
    rows.select(F.regexp_replace("text", r"\n\z", "").alias("text")).write.mode("error").option("maxRecordsPerFile", most).text(folder)  # the writer ends each with a line feed


def read_template(spark: SparkSession, folder: str) -> DataFrame:
    """The entries of a template's part files as of a catalogue; `path` and `pos` give their order."""
    from .po import read_po

    return read_po(spark, f"{folder}/part-*", once=True)


def simplified(lines: DataFrame, text: str = "text") -> DataFrame:
    """msgid lines for a template whose records are broken: the distinct ones of one line that aren't empty, sorted, each with an empty translation below."""
    seen = lines.filter(C(text).startswith("msgid") & (C(text) != 'msgid ""')).select(C(text).alias("line")).distinct()
    return seen.select("line", F.concat("line", F.lit('\nmsgstr ""\n\n')).alias("record")).orderBy("line")


def problems(entries: DataFrame) -> DataFrame:
    """msgid, problem of a template's entries as read: duplicate (but for the first) or untidy (a text has begun with a line feed and its plural hasn't, or ends so)."""
    live = entries.filter(~C("obsolete") & ~C("is_header"))
    twice = live.groupBy("msgid").agg(F.count("*").alias("n")).filter("n > 1").select("msgid", F.lit("duplicate").alias("problem"))
    plural = F.coalesce(C("msgid_plural"), F.lit("")) != ""
    uneven = plural & ((C("msgid").startswith("\n") != C("msgid_plural").startswith("\n")) | (C("msgid").endswith("\n") != C("msgid_plural").endswith("\n")))
    return twice.unionByName(live.filter(uneven).select("msgid", F.lit("untidy").alias("problem")))
