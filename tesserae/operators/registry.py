"""Registries from HTML, JSON and configuration text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import json_documents

C = F.col


def links(pages: DataFrame, html: str, pattern: str) -> DataFrame:
    """name: the distinct, sorted first groups of a pattern over pages."""
    return pages.select(F.explode(T.find(C(html), pattern, 1)).alias("name")).distinct().orderBy("name")


def services(bootstrap: DataFrame, body: str) -> DataFrame:
    """key, url of a bootstrap document {services: [[[keys], [urls]], ...]}; the first https URL of a service counts, else the first; of several services for a key the last.

    A document, or a service, of another shape fails the query.
    """
    rows = json_documents.services(bootstrap, body)
    urls = F.transform("urls", T.https_url)
    rows = rows.select("pos", F.explode("keys").alias("key"), F.coalesce(F.get(F.filter(urls, lambda u: u.startswith("https://")), 0), F.get(urls, 0)).alias("url"))
    return rows.groupBy(F.lower("key").alias("key")).agg(F.max_by("url", "pos").alias("url"))


def array_file(text: DataFrame, column: str) -> DataFrame:
    """key, value of lines 'key' => 'value'."""
    pattern = r"'([^']*)'\s*=>\s*'([^']*)'"
    return text.select(F.explode(F.arrays_zip(T.find(C(column), pattern, 1).alias("key"), T.find(C(column), pattern, 2).alias("value"))).alias("p")).select("p.key", "p.value")


def as_array_file(rows: DataFrame, key: str, value: str, banner: str) -> DataFrame:
    """The one text of a sorted array file."""
    line = F.concat(F.lit("    '"), C(key), F.lit("' => '"), C(value), F.lit("',"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(C(key).alias("k"), line.alias("l")))), lambda x: x["l"]), "\n")
    return rows.agg(F.concat(F.lit(f"<?php\n// {banner}, "), F.count("*").cast("string"), F.lit(" entries\nreturn [\n"), body, F.lit("\n];\n")).alias("value"))


def flattened(config: DataFrame, column: str, levels: int = 4) -> DataFrame:
    """path, value of a JSON object nested up to `levels` deep."""
    now = config.select(F.lit("").alias("path"), C(column).alias("value"))
    out = None
    for _ in range(levels):
        keys = F.json_object_keys("value")
        leaf = now.filter(keys.isNull())
        out = leaf if out is None else out.unionByName(leaf)
        inner = now.filter(keys.isNotNull()).select("path", F.explode(F.from_json("value", "map<string,string>")).alias("k", "v"))
        now = inner.select(F.concat_ws(".", F.nullif("path", F.lit("")), "k").alias("path"), C("v").alias("value"))
    return out.unionByName(now).filter(C("path") != "")


def word_list(names: DataFrame, column: str, width: int = 75) -> Column:
    """Lower-cased names quoted and joined; a caller folds lines."""
    return F.array_join(F.transform(F.array_sort(F.collect_set(F.lower(column))), lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")


def template_strings(lines: DataFrame, path: str, line: str, text: str) -> DataFrame:
    """msgid, path, line of {% trans 'x' %} and {{ 'x'|trans }} on single lines."""
    tag = r"\{%\s*trans\s+(?:'([^']*)'|\"([^\"]*)\")\s*%\}"
    piped = r"\{\{\s*(?:'([^']*)'|\"([^\"]*)\")\s*\|\s*trans\b"
    found = F.concat(*[F.zip_with(T.find(C(text), p, 1), T.find(C(text), p, 2), lambda a, b: F.when(a != "", a).otherwise(b)) for p in (tag, piped)])
    return lines.select(path, line, F.explode(found).alias("msgid")).select(T.strip(C("msgid")).alias("msgid"), path, line).filter(C("msgid") != "")


def glossary_terms(terms: DataFrame, corpus: DataFrame, term: str, text: str) -> DataFrame:
    """Terms that stand in some text of the corpus, bounded by other than letters or digits, with the number of texts.

    Texts are cut into distinct runs of letters and digits, and terms of one word meet them by
    an equi-join; no text is tried against every term.
    """
    words = corpus.select(F.monotonically_increasing_id().alias("_i"), F.explode(F.array_distinct(F.split(C(text), r"[^\p{L}\p{N}]+"))).alias("_w"))
    counts = words.groupBy("_w").agg(F.count("*").alias("n"))
    return terms.join(counts, C(term) == C("_w")).select(term, "n")
