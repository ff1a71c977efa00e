"""JSON documents of unknown shape: parsed to VARIANT, their shape checked, then read by path.

A document that isn't JSON, or whose shape is another than stated, either fails the query (checked) or is told in a report (faults); none passes as nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

C = F.col
KINDS = ("object", "array", "string", "number", "boolean", "null")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """path, text of files, a document each."""
    return spark.read.text(path, wholetext=True).select(C("_metadata.file_path").alias("path"), C("value").alias("text"))


def kind_at(doc: Column, path: str) -> Column:
    """object, array, string, number, boolean or null of what stands at a path of a variant; null where nothing does."""
    schema = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
    return (
        F.when(schema.startswith("OBJECT"), "object").when(schema.startswith("ARRAY"), "array").when(schema == "STRING", "string").when(schema == "BOOLEAN", "boolean")
        .when(schema == "VOID", "null").when(schema.isNotNull(), "number")
    )


def fault(text: Column, shape: dict[str, str]) -> Column:
    """What is wrong with a JSON text, null if nothing: `not JSON`, or the first path of shape (path -> kind; a ? behind it: may be absent) of another kind."""
    doc = F.try_parse_json(text)
    tests = F.when(doc.isNull(), "not JSON")
    for path, kind in shape.items():
        wanted, optional = kind.rstrip("?"), kind.endswith("?")
        if wanted not in KINDS:
            raise ValueError(f"unknown kind {kind!r}")
        found = kind_at(doc, path)
        wrong = (found != wanted) if optional else (found.isNull() | (found != wanted))
        tests = tests.when(F.coalesce(wrong, F.lit(False)), F.concat(F.lit(f"{path}: "), F.coalesce(found, F.lit("absent"))))
    return tests


def faults(rows: DataFrame, text: str, shape: dict[str, str]) -> DataFrame:
    """rows that don't have the shape, with `fault`."""
    return rows.withColumn("fault", fault(C(text), shape)).filter(C("fault").isNotNull())


def checked(rows: DataFrame, text: str, shape: dict[str, str], name: str = "doc") -> DataFrame:
    """rows with the text as a variant; a query that meets a row of another shape fails with the fault and the text's beginning."""
    wrong = fault(C(text), shape)
    message = F.concat(F.lit("unexpected document, "), wrong, F.lit(": "), F.coalesce(F.left(C(text), F.lit(80)), F.lit("null")))
    return rows.withColumn(name, F.when(wrong.isNotNull(), F.raise_error(message).cast("variant")).otherwise(F.parse_json(text)))


def exclusions(rows: DataFrame, text: str = "text") -> DataFrame:
    """term: distinct terms of {exclusions: [term, ...]}."""
    doc = checked(rows, text, {"$.exclusions": "array"})
    return doc.select(F.explode(F.variant_get("doc", "$.exclusions", "array<string>")).alias("term")).distinct()


def plural_rules(rows: DataFrame, text: str = "text") -> DataFrame:
    """code, rule of {rules: {code: Plural-Forms value}}."""
    doc = checked(rows, text, {"$.rules": "object"})
    return doc.select(F.explode(F.variant_get("doc", "$.rules", "map<string,string>")).alias("code", "rule"))


def agreed_terms(rows: DataFrame, text: str = "text") -> DataFrame:
    """term, locale, renderings of {term: {locale: [rendering, ...]}}; names with an underscore in front describe the file."""
    doc = checked(rows, text, {"$": "object"})
    terms = doc.select(F.explode(F.variant_get("doc", "$", "map<string,variant>")).alias("term", "v")).filter(~C("term").startswith("_"))
    return terms.select("term", F.explode(F.variant_get("v", "$", "map<string,array<string>>")).alias("locale", "renderings"))


def glossary(rows: DataFrame, text: str = "text", group: str = "literal") -> DataFrame:
    """term, note, exempt of {group: [{term, note, exempt_locales}, ...]}; a term without exempt locales is exempt nowhere."""
    doc = checked(rows, text, {f"$.{group}": "array"})
    entries = doc.select(F.explode(F.variant_get("doc", f"$.{group}", "array<variant>")).alias("v"))
    one = lambda path, kind: F.variant_get("v", path, kind)
    return entries.select(one("$.term", "string").alias("term"), one("$.note", "string").alias("note"), F.coalesce(one("$.exempt_locales", "array<string>"), F.array().cast("array<string>")).alias("exempt"))


def services(rows: DataFrame, text: str = "text") -> DataFrame:
    """pos, keys, urls of a bootstrap {services: [[[key, ...], [url, ...]], ...]}; a service of another shape fails the query."""
    doc = checked(rows, text, {"$.services": "array"})
    found = doc.select(F.posexplode(F.variant_get("doc", "$.services", "array<array<array<string>>>")).alias("pos", "s"))
    wrong = F.coalesce((F.size("s") < 2) | F.exists("s", lambda x: x.isNull()), F.lit(True))
    held = F.when(wrong, F.raise_error(F.concat(F.lit("unexpected service at "), C("pos").cast("string"))).cast("array<array<string>>")).otherwise(C("s"))
    return found.select("pos", held.alias("s")).select("pos", C("s")[0].alias("keys"), C("s")[1].alias("urls"))
