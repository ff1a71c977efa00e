"""Operators over catalogue entries as tesserae.sources.po reads them: issues, exports, imports, plural corrections, headers, glossaries, reports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import plural
from ..functions import text as T
from . import checks, ordered, relational, stats

C = F.col


def live(entries: DataFrame) -> DataFrame:
    return entries.filter(~C("obsolete") & (C("msgid") != ""))


def has_plural() -> Column:
    return F.coalesce(C("msgid_plural"), F.lit("")) != ""


def is_open(home: str = "en_EN") -> Column:
    """An entry that has still to be translated: a text or a form is empty, or an echo outside of the home locale."""
    forms = F.exists(F.map_values("plurals"), lambda v: (v == "") | ((C("locale") != home) & ((v == C("msgid")) | (v == C("msgid_plural"))))) | (F.size("plurals") == 0)
    return F.when(has_plural(), F.coalesce(forms, F.lit(True))).otherwise(stats.is_untranslated(C("msgid"), C("msgstr"), C("locale"), home))


def issues(entries: DataFrame, exclusions: list[str], home: str = "en_EN") -> DataFrame:
    """locale, pos, form, issue: empty or untranslated, and for the forms of a plural empty_plural or untranslated_plural. form is -1 for a singular."""

    def kind(value: Column, suffix: str) -> Column:
        return F.when(F.coalesce(value, F.lit("")) == "", f"empty{suffix}").when((value == C("msgid")) & (C("locale") != home), f"untranslated{suffix}")

    forms = F.transform(F.map_entries("plurals"), lambda x: F.struct(x["key"].cast("int").alias("form"), kind(x["value"], "_plural").alias("issue")))
    single = F.array(F.struct(F.lit(-1).alias("form"), kind(C("msgstr"), "").alias("issue")))
    rows = live(entries).filter(~stats.is_excluded(C("msgid"), exclusions)).select("locale", "pos", F.explode(F.when(has_plural(), forms).otherwise(single)).alias("f"))
    return rows.select("locale", "pos", "f.form", "f.issue").filter(C("issue").isNotNull())


def issue_report(entries: DataFrame, found: DataFrame) -> DataFrame:
    """locale, empty, untranslated, clean for every locale, also those without findings."""
    counts = found.groupBy("locale").agg(F.count_if(C("issue").startswith("empty")).alias("empty"), F.count_if(C("issue").startswith("untranslated")).alias("untranslated"))
    rows = entries.select("locale").distinct().join(counts, "locale", "left").na.fill(0, ["empty", "untranslated"])
    return rows.withColumn("clean", C("empty") + C("untranslated") == 0)


# --- export and import ---------------------------------------------------------------------


def sections(entries: DataFrame, exclusions: list[str]) -> DataFrame:
    """Live entries with open and section: excluded, fuzzy or untranslated for those to be worked on, else null. fuzzy comes before untranslated."""
    rows = live(entries).withColumn("open", is_open())
    section = F.when(stats.is_excluded(C("msgid"), exclusions), "excluded").when(C("is_fuzzy"), "fuzzy").otherwise("untranslated")
    return rows.withColumn("section", F.when(C("is_fuzzy") | C("open"), section))


def export_counts(entries: DataFrame, exclusions: list[str]) -> DataFrame:
    """locale, untranslated_count, fuzzy_count, excluded_count, total_untranslated (fuzzy ones that are open count there too)."""
    one = lambda name: F.count_if(C("section") == name)
    return sections(entries, exclusions).groupBy("locale").agg(
        one("untranslated").alias("untranslated_count"), one("fuzzy").alias("fuzzy_count"), one("excluded").alias("excluded_count"),
        F.count_if(C("open") & (C("section") != "excluded")).alias("total_untranslated"),
    )


def exported(entries: DataFrame, exclusions: list[str], limit: int = 0) -> DataFrame:
    """locale, section, pos, entry: what translators get, one JSON object a row, the first `limit` of each section (0: all)."""
    rows = relational.kept_first(sections(entries, exclusions).filter(C("section").isin("fuzzy", "untranslated")), ["locale", "section"], "pos", limit)
    fuzzy, several = C("section") == "fuzzy", has_plural()
    places = C("locations") if "locations" in entries.columns else F.array().cast("array<string>")
    notes = F.when(F.size("comments") > 0, C("comments")) if "comments" in entries.columns else F.lit(None).cast("array<string>")
    entry = F.struct(
        F.coalesce(places, F.array().cast("array<string>")).alias("locations"), "msgid", F.when(fuzzy, C("msgstr")).alias("current_translation"), F.lit("").alias("translation"), F.when(several, C("msgid_plural")).alias("msgid_plural"),
        F.when(fuzzy & several, C("plurals")).alias("current_translations"), F.when(several, F.create_map().cast("map<string,string>")).alias("translations"),
        notes.alias("comments"),
    )
    return rows.select("locale", "section", "pos", F.to_json(entry).alias("entry"))


def failing_template(entries: DataFrame, failing: DataFrame) -> DataFrame:
    """locale, entry: {msgid: ""} for each failing msgid (locale, msgid), one a row."""
    rows = live(entries).join(failing.select("locale", "msgid").distinct(), ["locale", "msgid"], "left_semi")
    return rows.select("locale", F.to_json(F.create_map("msgid", F.lit(""))).alias("entry")).distinct()


def dict_payload(entries: DataFrame, given: DataFrame, declared: DataFrame, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(payload, rejected) of a dictionary (locale, msgid, text, forms map<string,string>; either text or forms is null).

    declared: locale, nplurals. Only entries that are open or fuzzy take part, or all with force. A plural needs exactly the
    declared forms, a singular one text; a locale with a rejected entry gets no payload at all.
    """
    g = given.select(C("locale").alias("_l"), C("msgid").alias("_k"), "text", "forms")
    d = declared.select(C("locale").alias("_d"), "nplurals")
    rows = live(entries).join(g, (C("locale") == C("_l")) & (C("msgid") == C("_k"))).join(d, C("locale") == C("_d"), "left")
    if not force:
        rows = rows.filter(is_open() | C("is_fuzzy"))
    wanted = F.array_sort(F.transform(F.sequence(F.lit(0), C("nplurals") - 1), lambda i: i.cast("string")))
    reason = (
        F.when(has_plural() & C("forms").isNull(), "needs_forms").when(has_plural() & (F.array_sort(F.map_keys("forms")) != wanted), "other_forms")
        .when(~has_plural() & C("forms").isNotNull(), "needs_one_text")
    )
    rows = rows.withColumn("reason", reason)
    rejected = rows.filter(C("reason").isNotNull()).select("locale", "pos", "msgid", "reason")
    kept = rows.filter(C("reason").isNull()).join(rejected.select("locale").distinct(), "locale", "left_anti")
    return kept.select("locale", "pos", "msgid", "msgid_plural", C("text").alias("translation"), C("forms").alias("translations"), "is_fuzzy"), rejected


def plural_fixes(entries: DataFrame, proposals: DataFrame, declared: DataFrame, literals: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(planned, problems) of corrections (locale, msgid, form, text) of plural forms; locales with a problem plan nothing.

    Different texts for one form are a conflict. Form 0 is held against msgid, the others against msgid_plural.
    """
    fixes = proposals.groupBy("locale", "msgid", "form").agg(F.min("text").alias("text"), F.count_distinct("text").alias("n_texts"))
    e = live(entries).select(C("locale").alias("_l"), C("msgid").alias("_k"), "pos", "msgid_plural", "plurals")
    d = declared.select(C("locale").alias("_d"), "nplurals")
    rows = fixes.join(e, (C("locale") == C("_l")) & (C("msgid") == C("_k")), "left").join(d, C("locale") == C("_d"), "left")
    source = F.when(C("form") == 0, C("msgid")).otherwise(C("msgid_plural"))
    reasons = (
        F.when(C("n_texts") > 1, F.array(F.lit("conflict"))).when(C("_k").isNull(), F.array(F.lit("unknown"))).when(~has_plural(), F.array(F.lit("not_plural")))
        .when((C("form") < 0) | F.coalesce(C("form") >= C("nplurals"), F.lit(False)), F.array(F.lit("index"))).otherwise(checks.gate_reasons(source, C("text"), C("locale"), literals))
    )
    rows = rows.withColumn("reasons", reasons)
    problems = rows.filter(F.size("reasons") > 0).select("locale", "msgid", "form", F.array_join("reasons", "|").alias("reasons"))
    planned = rows.filter((F.size("reasons") == 0) & ~F.coalesce(F.try_element_at("plurals", C("form")) == C("text"), F.lit(False)))
    return planned.join(problems.select("locale").distinct(), "locale", "left_anti").select("locale", "pos", "msgid", "form", "text"), problems


def new_locale(entries: DataFrame, done: DataFrame, locale: str, rule: str) -> DataFrame:
    """entries of a catalogue as a new locale's, with `source` (translated, source or null for headers and obsolete entries).

    done: source, translation of distinct texts, singular and plural ones alike; what it lacks, or has as null, keeps its source. Form 0 of a plural is the singular's translation and so
    is the only form there is; all others get the plural's, as placeholders where there are more than two. rule: the new Plural-Forms value.
    """
    nplurals = plural.header_parts(rule)[0]
    known = done.filter(C("translation").isNotNull()).groupBy("source").agg(F.min("translation").alias("translation"))
    one = known.select(C("source").alias("_s1"), C("translation").alias("_t1"))
    many = known.select(C("source").alias("_s2"), C("translation").alias("_t2"))
    rows = entries.join(one, C("msgid") == C("_s1"), "left").join(many, has_plural() & (C("msgid_plural") == C("_s2")), "left")
    live_ = ~C("obsolete") & ~C("is_header") & (C("msgid") != "")
    single, several = F.coalesce("_t1", "msgid"), F.coalesce("_t2", "msgid_plural")
    forms = F.map_from_arrays(F.sequence(F.lit(0), F.lit(nplurals - 1)), F.concat(F.array(single), F.array_repeat(several, nplurals - 1)))
    head = with_header_field(with_header_field(with_header_field(C("msgstr"), "Language", F.lit(locale)), "Last-Translator", F.lit("Automatically generated")), "Plural-Forms", F.lit(rule))
    missing = C("_t1").isNull() | (has_plural() & C("_t2").isNull())
    values = {
        "msgstr": F.when(C("is_header"), head).when(live_ & ~has_plural(), single).otherwise(C("msgstr")), "plurals": F.when(live_ & has_plural(), forms).otherwise(C("plurals")),
        "source": F.when(live_, F.when(missing, "source").otherwise("translated")), "locale": F.lit(locale),
    }
    return rows.withColumns(values).drop("_s1", "_t1", "_s2", "_t2")


def without_obsolete(entries: DataFrame, template: DataFrame) -> DataFrame:
    """Entries that aren't obsolete and whose msgid the template has; the header stays. The last one kept of a catalogue is followed by one line feed."""
    known = template.select(C("msgid").alias("_k")).distinct()
    kept = entries.filter(~C("obsolete") | (C("msgid") == "")).join(known, C("msgid") == C("_k"), "left").filter(C("_k").isNotNull() | (C("msgid") == "")).drop("_k")
    last = kept.groupBy(C("path").alias("_path")).agg(F.max("pos").alias("_last"))
    return kept.join(last, C("path") == C("_path")).withColumn("sep", F.when(C("pos") == C("_last"), "\n").otherwise(C("sep"))).drop("_path", "_last")


# --- headers and plural rules --------------------------------------------------------------


def header_field(header: Column, name: str) -> Column:
    """The value of a header field, null where it is absent."""
    line = rf"(?m)^{re.escape(name)}:[ \t]*(.*?)[ \t]*$"
    return F.when(header.rlike(line), F.regexp_extract(header, line, 1))


def with_header_field(header: Column, name: str, value: Column) -> Column:
    """The header with the field's value replaced, or with the field at its end."""
    line = rf"(?m)^{re.escape(name)}:.*$"
    field = F.concat(F.lit(f"{name}: "), value)
    quoted = F.regexp_replace(field, r"([\\$])", r"\\$1")
    ends = F.when((header == "") | header.endswith("\n"), header).otherwise(F.concat(header, F.lit("\n")))
    return F.when(header.rlike(line), F.regexp_replace(header, F.lit(line), quoted)).otherwise(F.concat(ends, field, F.lit("\n")))


def header_text(fields: list[tuple[str, Column]]) -> Column:
    """A new header from its fields, in order."""
    return F.concat(*[F.concat(F.lit(f"{name}: "), value, F.lit("\n")) for name, value in fields])


def stamp(at: Column) -> Column:
    """A time as headers write it."""
    return F.date_format(at, "yyyy-MM-dd HH:mmZ")


def plural_forms(entries: DataFrame, rules: dict[str, str]) -> DataFrame:
    """locale, pos, fault of catalogues whose plural rule or forms are wrong; pos is null for faults of the header.

    rules: language -> Plural-Forms value. no_rule: the header has none; unknown_language: there is no rule to compare with, and none is
    guessed; other_rule: different forms for some n up to 200; forms: an entry's forms aren't those the header declares. The first two
    end a catalogue's check. One header a locale comes to the driver.
    """
    spark = entries.sparkSession
    headers = entries.groupBy("locale").agg(F.max_by("msgstr", C("is_header")).alias("text"), F.bool_or("is_header").alias("has"))
    found = headers.select("locale", F.when(C("has"), header_field(C("text"), "Plural-Forms")).alias("rule")).collect()
    faults, declared, pairs = [], [], {}
    for locale, rule in sorted((r.locale, r.rule) for r in found if r.locale is not None):
        expected = rules.get(locale.split("_")[0].lower())
        if rule is None or expected is None:
            faults.append((locale, "no_rule" if rule is None else "unknown_language"))
            continue
        (n, own), (m, other) = plural.header_parts(rule), plural.header_parts(expected)
        declared.append((locale, n))
        if n != m:
            faults.append((locale, "other_rule"))
        else:
            pairs[locale] = own, other
    faults += [(locale, "other_rule") for locale in sorted(plural.differing(spark, pairs))]
    head = spark.createDataFrame(faults, "locale string, fault string").select("locale", F.lit(None).cast("long").alias("pos"), "fault")
    counts = spark.createDataFrame(declared, "_l string, nplurals int")
    rows = live(entries).filter(has_plural()).join(F.broadcast(counts), C("locale") == C("_l"))  # a row a locale
    wrong = rows.filter(F.coalesce(plural.forms_fault(C("plurals"), C("nplurals")), F.lit(True)))
    return head.unionByName(wrong.select("locale", C("pos").cast("long").alias("pos"), F.lit("forms").alias("fault")))


# --- glossary ------------------------------------------------------------------------------


def message_corpus(*catalogues: DataFrame) -> DataFrame:
    """msgid: the distinct singular and plural sources of catalogues."""
    out = None
    for c in catalogues:
        ids = c.filter(~C("obsolete") & ~C("is_header")).select(F.explode(F.array("msgid", F.coalesce("msgid_plural", F.lit("")))).alias("msgid"))
        out = ids if out is None else out.unionByName(ids)
    return out.filter(C("msgid") != "").distinct()


def constants(files: DataFrame, text: str) -> DataFrame:
    """name: constants of source files whose value is their own name."""
    return files.select(F.explode(T.find(C(text), r"(?m)^\s*public const ([A-Z][A-Z0-9]*) = '\1';", 1)).alias("name")).distinct()


def dropped_terms(pairs: DataFrame, glossary: list[tuple[str, list[str]]]) -> DataFrame:
    """locale, pos, term: literals (term, exempt locales) that the source has and the target has not.

    The glossary is a short list given by the caller; the plan holds a test for each term, no join.
    """
    hits = [F.when(checks.term_dropped(C("src"), C("dst"), C("locale"), term, exempt), F.lit(term)) for term, exempt in glossary]
    return pairs.select("locale", "pos", F.explode(F.array_compact(F.array(*hits))).alias("term"))


def glossary_document(terms: DataFrame, corpus: DataFrame) -> DataFrame:
    """group, term, entry (JSON) of the terms (group, term, note, source; of equal terms the first by group and note) that stand in some text of the corpus (text), by group and lower-case term."""
    one = terms.groupBy("term").agg(F.min(F.struct("group", "note", "source")).alias("f")).select("f.group", "term", "f.note", "f.source")
    words = corpus.select(F.explode(F.array_distinct(T.find(C("text"), r"[\p{L}\p{N}]+"))).alias("term")).distinct()
    kept = one.join(words, "term", "left_semi")
    return kept.select("group", "term", F.to_json(F.struct("term", "group", "note", "source")).alias("entry")).orderBy("group", F.lower("term"), "term")


# --- reports -------------------------------------------------------------------------------


def rollup(pairs: DataFrame) -> DataFrame:
    """One row over catalogues: scanned, affected, mojibake, hidden, artifacts."""
    hidden, damaged = F.size(checks.hidden_in(C("dst"), C("locale"))), F.size(checks.mojibake_in(C("dst")))
    own = pairs.groupBy("locale").agg(F.sum(damaged).alias("mojibake"), F.sum(hidden).alias("hidden"))
    marks = checks.translation_artifacts(pairs).groupBy("locale").agg(F.sum("n").alias("artifacts"))
    rows = own.join(marks, "locale", "left").na.fill(0, ["mojibake", "hidden", "artifacts"])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return rows.agg(F.count("*").alias("scanned"), F.count_if(C("mojibake") + C("hidden") + C("artifacts") > 0).alias("affected"), *map(total, ("mojibake", "hidden", "artifacts")))


def top_patterns(found: DataFrame, pattern: str, pos: str, n: int = 6) -> DataFrame:
    """pattern, n, more: the n most frequent patterns, of equal ones the earliest, and how many others there are."""
    counts = found.groupBy(C(pattern).alias("pattern")).agg(F.count("*").alias("n"), F.min(pos).alias("_first"))
    top = counts.orderBy(F.desc("n"), "_first", "pattern").limit(n)
    return top.crossJoin(F.broadcast(counts.agg(F.count("*").alias("_all")))).select("pattern", "n", F.greatest(C("_all") - n, F.lit(0)).alias("more"))  # one row


def suspect_characters(pairs: DataFrame) -> DataFrame:
    """locale, pos, chars: map of each suspect character of a target to its number."""
    rows = checks.translation_artifacts(pairs).groupBy("locale", "pos").agg(F.array_sort(F.collect_list(F.struct("ch", "n"))).alias("f"))
    return rows.select("locale", "pos", F.map_from_entries("f").alias("chars"))


def carried_ids(lines: DataFrame, path: str, line: str, text: str) -> DataFrame:
    """path, line, msgid, msgstr: each msgstr line with the msgid before it in its file."""
    form = r'^{}(?:\[\d+\])? "(.*)"\s*$'
    quoted = lambda name: F.when(C(text).rlike(form.format(name)), F.regexp_extract(text, form.format(name), 1))
    rows = lines.select(path, line, quoted("msgid").alias("_id"), quoted("msgstr").alias("msgstr"))
    return ordered.carried(rows, [path], line, {"msgid": C("_id")}).filter(C("msgstr").isNotNull()).select(path, line, "msgid", "msgstr")


def filtered_digests(lines: DataFrame, path: str, line: str, text: str, without: str, block: int = 4096) -> DataFrame:
    """path, md5 of each file without the lines that match `without`: two versions that differ in those alone are equal.

    The digest is that of the digests of each `block` lines kept, so no file is held as one.
    """
    kept = F.coalesce(~C(text).rlike(without), F.lit(False))
    rows = ordered.running_sums(lines.select(path, line, text, kept.cast("int").alias("_kept")), [path], line, {"_no": C("_kept")}).withColumn("_part", F.floor(C("_no") / block))
    parts = rows.groupBy(path, "_part").agg(F.array_sort(F.collect_list(F.when(C("_kept") == 1, F.struct(C(line).alias("at"), C(text).alias("t"))))).alias("_l"), F.sum("_kept").alias("_n"))
    digests = parts.select(path, "_part", F.when(C("_n") > 0, F.md5(F.array_join(F.transform("_l", lambda x: x["t"]), "\n"))).alias("_md5"))
    return digests.groupBy(path).agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(C("_md5").isNotNull(), F.struct("_part", "_md5")))), lambda x: x["_md5"]), "")).alias("md5"))


def statistics_counts(logs: DataFrame, text: str) -> DataFrame:
    """One row: translated, fuzzy, untranslated, summed over lines of message statistics."""
    number = lambda name: F.coalesce(F.sum(F.regexp_extract(text, rf"(\d+) {name}\b", 1).try_cast("long")), F.lit(0)).alias(name)
    return logs.agg(*map(number, ("translated", "fuzzy", "untranslated")))


def missing_count(template: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row: how many entries a merge with the template would add."""
    return relational.stale(template.select("msgid").distinct(), catalogue, "msgid").agg(F.count("*").alias("missing"))


def catalogue_path(root: str, locale: Column, module: Column) -> Column:
    """Where the catalogue of a locale, or of a module (null: none) in it, stands."""
    main = F.concat(F.lit(f"{root}/locale/"), locale, F.lit("/LC_MESSAGES/messages.po"))
    return F.when(module.isNull(), main).otherwise(F.concat(F.lit(f"{root}/lib/Module/"), module, F.lit("/locale/"), locale, F.lit("/messages.po")))


def tracked_secrets(tracked: DataFrame, sensitive: DataFrame, path: str = "path") -> DataFrame:
    """Sensitive paths that are under version control."""
    return tracked.join(sensitive.select(path).distinct(), path, "left_semi")
