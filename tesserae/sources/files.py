"""Scans of source trees and small text files, through Spark's readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Folder

C = F.col


def whole_files(spark: SparkSession, path: str, names: str = "*", skip: str | None = None) -> DataFrame:
    """path, modified, content of files below a folder whose names fit a glob; paths that match `skip` are left out before they are read further."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(path)
    out = read.select("path", C("modificationTime").alias("modified"), "content")
    return out.filter(~C("path").rlike(skip)) if skip else out


def walked(spark: SparkSession, root: str, pruned: tuple[str, ...] = (".git", "vendor", "node_modules"), suffixes: tuple[str, ...] = (), most: int = 10_000_000) -> DataFrame:
    """path, modified, content of the files of a tree without the folders of a pruned name, files with one of the suffixes and files over `most` bytes.

    Folders are listed by the driver, pruned ones never; files are listed and read by Spark, which skips large ones by their length before it reads them.
    """
    folders, left = [], [root.rstrip("/")]
    while left:
        at = left.pop()
        folders.append(at)
        left += [f"{at}/{x}" for x in Folder(spark, at).folders() if x not in pruned]
    read = spark.read.format("binaryFile").load(sorted(folders)).filter(C("length") <= most)
    out = read.select("path", C("modificationTime").alias("modified"), "content")
    for suffix in suffixes:
        out = out.filter(~C("path").endswith(suffix))
    return out


def texts(files: DataFrame) -> DataFrame:
    """Files that are UTF-8, with `text` in place of content."""
    return files.filter(F.is_valid_utf8(C("content").cast("string"))).select("path", "modified", C("content").cast("string").alias("text"))


def lines(files: DataFrame) -> DataFrame:
    """path, line (1-based), text."""
    return files.select("path", F.posexplode(F.split("text", "\n")).alias("line", "text")).withColumn("line", C("line") + 1)


def invalid(files: DataFrame) -> DataFrame:
    return files.filter(~F.is_valid_utf8(C("content").cast("string"))).select("path")


def without_marker(files: DataFrame, marker: str) -> DataFrame:
    """Files that nowhere hold a text, such as a license notice."""
    return files.filter(~F.contains("text", F.lit(marker))).select("path")


def older_than(files: DataFrame, days: int, today: Column | None = None) -> DataFrame:
    age = F.datediff(F.current_date() if today is None else today, F.to_date("modified"))
    return files.select("path", age.alias("age")).filter(C("age") > days)


def versions(files: DataFrame, name: str = "VERSION") -> DataFrame:
    """path, version of constants NAME = 'x.y.z'."""
    found = F.regexp_extract("text", rf"{name}['\"]?\s*(?:=>|=|,)\s*['\"]([0-9][0-9A-Za-z.\-]*)['\"]", 1)
    return files.select("path", found.alias("version")).filter(C("version") != "")


def list_entries(spark: SparkSession, path: str, comment: str = "#") -> DataFrame:
    """Distinct lower-cased entries of a list file, without comments and empty lines."""
    rows = spark.read.text(path).select(F.lower(F.trim("value")).alias("name"))
    return rows.filter((C("name") != "") & ~C("name").startswith(comment)).distinct()


def diagnostics(spark: SparkSession, path: str) -> DataFrame:
    """Line numbers `file:<n>:` of a checker's messages, warnings left out."""
    rows = spark.read.text(path).filter(~F.lower("value").contains("warning"))
    return rows.select(F.regexp_extract("value", r":(\d+):", 1).alias("n")).filter("n <> ''").select(C("n").cast("int").alias("line")).distinct()


def proposals(spark: SparkSession, path: str) -> DataFrame:
    """locale, family, msgid, text of files OUT_<locale>_<family><n>.json, each an object msgid -> text."""
    read = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^OUT_(.+)_([a-z]+)[0-9]*\.json$", 1).alias("locale"), F.regexp_extract("_metadata.file_name", r"^OUT_(.+)_([a-z]+)[0-9]*\.json$", 2).alias("family"), F.from_json("value", "map<string,string>").alias("m"))
    return read.select("locale", "family", F.explode("m").alias("msgid", "text"))
