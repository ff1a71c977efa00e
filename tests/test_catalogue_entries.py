"""Catalogue entries: exports, imports, corrections, headers and glossary on small cases."""

import json

import pytest
from pyspark.sql import functions as F

from tesserae.operators import catalogue

C = F.col
ENTRY = "locale string, path string, pos long, msgid string, msgid_plural string, msgstr string, plurals map<int,string>, is_fuzzy boolean, obsolete boolean, is_header boolean, sep string"


@pytest.fixture(scope="module")
def entries(spark):
    rows = [
        ("fr", "fr.po", 0, "", None, "Language: fr\nPlural-Forms: nplurals=2; plural=(n>1);\n", {}, False, False, True, "\n\n"),
        ("fr", "fr.po", 1, "%d zone", "%d zones", "", {0: "%d zone", 1: ""}, False, False, False, "\n\n"),
        ("fr", "fr.po", 2, "Save", "", "Garder", {}, True, False, False, "\n\n"),
        ("fr", "fr.po", 3, "Gone", "", "Parti", {}, False, True, False, "\n\n"),
        ("fr", "fr.po", 4, "API", None, None, {}, False, False, False, "\n\n"),
        ("fr", "fr.po", 5, "%d file", "%d files", "", {0: "%d fichier"}, False, False, False, "\n\n\n"),
    ]
    return spark.createDataFrame(rows, ENTRY)


def test_issues_and_report(entries):
    found = catalogue.issues(entries, ["API"])
    assert sorted((r.pos, r.form, r.issue) for r in found.collect()) == [(1, 0, "untranslated_plural"), (1, 1, "empty_plural")]
    assert catalogue.issue_report(entries, found).collect()[0].asDict() == {"locale": "fr", "empty": 1, "untranslated": 1, "clean": False}
    assert catalogue.issues(entries.limit(0), ["API"]).count() == 0


def test_export(entries):
    got = {(r.section, r.pos): json.loads(r.entry) for r in catalogue.exported(entries, ["API"]).collect()}
    assert got == {
        ("untranslated", 1): {"locations": [], "msgid": "%d zone", "translation": "", "msgid_plural": "%d zones", "translations": {}},
        ("fuzzy", 2): {"locations": [], "msgid": "Save", "current_translation": "Garder", "translation": ""},
    }
    placed = entries.withColumns({"locations": F.array(F.lit("a.php:1")), "comments": F.when(C("pos") == 1, F.array(F.lit("note"))).otherwise(F.array().cast("array<string>"))})
    shown = {r.pos: json.loads(r.entry) for r in catalogue.exported(placed, ["API"]).collect()}
    assert shown[1]["locations"] == ["a.php:1"] and shown[1]["comments"] == ["note"] and "comments" not in shown[2]
    counts = catalogue.export_counts(entries, ["API"]).collect()[0].asDict()
    assert counts == {"locale": "fr", "untranslated_count": 1, "fuzzy_count": 1, "excluded_count": 1, "total_untranslated": 1}


def test_dictionary_is_taken_whole_or_not(spark, entries):
    schema = "locale string, msgid string, text string, forms map<string,string>"
    declared = spark.createDataFrame([("fr", 2)], "locale string, nplurals int")
    good = spark.createDataFrame([("fr", "%d zone", None, {"0": "a %d", "1": "b %d"}), ("fr", "Save", "Sauver", None), ("fr", "Unknown", "x", None)], schema)
    payload, rejected = catalogue.dict_payload(entries, good, declared)
    assert sorted(r.pos for r in payload.collect()) == [1, 2] and rejected.count() == 0
    bad = spark.createDataFrame([("fr", "%d zone", "a", None), ("fr", "Save", None, {"0": "x"}), ("fr", "%d file", None, {"0": "x"})], schema)
    payload, rejected = catalogue.dict_payload(entries, bad, declared, force=True)
    assert payload.count() == 0
    assert sorted((r.pos, r.reason) for r in rejected.collect()) == [(1, "needs_forms"), (2, "needs_one_text"), (5, "other_forms")]


def test_plural_fixes(spark, entries):
    declared = spark.createDataFrame([("fr", 2)], "locale string, nplurals int")
    schema = "locale string, msgid string, form int, text string"
    good = spark.createDataFrame([("fr", "%d zone", 1, "%d zones ici"), ("fr", "%d file", 0, "%d fichier")], schema)
    planned, problems = catalogue.plural_fixes(entries, good, declared)
    assert [(r.pos, r.form) for r in planned.collect()] == [(1, 1)] and problems.count() == 0
    bad = [("fr", "%d zone", 0, "zone"), ("fr", "%d zone", 2, "%d x"), ("fr", "%d zone", -1, "%d x"), ("fr", "Save", 0, "x"), ("fr", "No", 0, "x"), ("fr", "%d file", 0, "%d a"), ("fr", "%d file", 0, "%d b")]
    planned, problems = catalogue.plural_fixes(entries, good.unionByName(spark.createDataFrame(bad, schema)), declared)
    assert planned.count() == 0
    assert {(r.msgid, r.form): r.reasons for r in problems.collect()} == {
        ("%d zone", 0): "placeholders", ("%d zone", 2): "index", ("%d zone", -1): "index", ("Save", 0): "not_plural", ("No", 0): "unknown", ("%d file", 0): "conflict",
    }


def test_obsolete_removal_ends_with_one_line_feed(spark, entries):
    template = spark.createDataFrame([("%d zone",), ("Save",)], "msgid string")
    got = catalogue.without_obsolete(entries, template).orderBy("pos").collect()
    assert [(r.pos, r.sep) for r in got] == [(0, "\n\n"), (1, "\n\n"), (2, "\n")]


def test_headers(spark, entries):
    head = spark.createDataFrame([("Language: fr\nX-A: b  \n",), ("Language: fr",), ("",)], "h string")
    got = head.select(catalogue.header_field(C("h"), "X-A").alias("v"), catalogue.with_header_field(C("h"), "X-A", F.lit(r"$1\n")).alias("n")).collect()
    assert [tuple(r) for r in got] == [("b", "Language: fr\nX-A: $1\\n\n"), (None, "Language: fr\nX-A: $1\\n\n"), (None, "X-A: $1\\n\n")]


@pytest.mark.parametrize(("rules", "faults"), [
    ({"fr": "nplurals=2; plural=n>1;"}, [(5, "forms")]), ({"fr": "nplurals=2; plural=n!=1;"}, [(None, "other_rule"), (5, "forms")]), ({}, [(None, "unknown_language")]),
])
def test_plural_forms(entries, rules, faults):
    assert sorted(((r.pos, r.fault) for r in catalogue.plural_forms(entries, rules).collect()), key=str) == sorted(faults, key=str)
    assert [r.fault for r in catalogue.plural_forms(entries.filter(~C("is_header")), rules).collect()] == ["no_rule"]


def test_glossary_terms(spark):
    rows = [(0, "fr", "Use supermasters now", "Utiliser"), (1, "fr", "the KEY", "la clef"), (2, "fr", "a key", "x"), (3, "fr", "my-KEY", "x"), (4, "fr", "SSL/TLS", "ssl / tls"), (5, "de", "the KEY", "x"), (6, "fr", None, None)]
    pairs = spark.createDataFrame(rows, "pos long, locale string, src string, dst string")
    got = catalogue.dropped_terms(pairs, [("supermaster", []), ("KEY", ["de"]), ("SSL/TLS", [])]).collect()
    assert sorted((r.pos, r.term) for r in got) == [(0, "supermaster"), (1, "KEY")]


def test_paths_and_templates(spark, entries):
    got = spark.createDataFrame([("fr", None), ("fr", "Dns")], "l string, m string").select(catalogue.catalogue_path("r", C("l"), C("m")).alias("p")).collect()
    assert [r.p for r in got] == ["r/locale/fr/LC_MESSAGES/messages.po", "r/lib/Module/Dns/locale/fr/messages.po"]
    failing = spark.createDataFrame([("fr", "Save"), ("fr", "Save"), ("fr", "Gone")], "locale string, msgid string")
    assert [json.loads(r.entry) for r in catalogue.failing_template(entries, failing).collect()] == [{"Save": ""}]
