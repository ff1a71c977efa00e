import random

import pytest
from pyspark.sql import functions as F

from tesserae.functions import plural, similarity
from tesserae.functions import text as T
from tesserae.operators import checks, diacritics, registry, relational, reports, rewrite, stats, verify

C = F.col

# (class, source, target, locale, finding)
CASES = [
    ("placeholder", "%s of %d", "%d of %s", "fr", False), ("placeholder", "%1$s", "%s", "fr", False), ("placeholder", "0x%04X", "0x% 4X", "fr", True),
    ("leak", "%d%%", "%d%%-ot", "hu", False), ("leak", "%s x", "%sZ x", "fr", True),
    ("tags", "<b>a</b>", "<b>a", "fr", True), ("tags", "<priority>", "<priorité>", "fr", False),
    ("tokens", "[ZONE]", "[ZONA]", "es", True), ("identifiers", "use user_name", "use user name", "fr", True),
    ("trailing", "a ", "b", "fr", True), ("boilerplate", "Quote", "citationstegn", "da", False), ("boilerplate", "x", "x [a | b]", "he_IL", True),
    ("mixedscript", "DNS zone", "ДНС зона", "ru_RU", True), ("mixedscript", "note", "WARNINGΟΠΟ", "el_GR", True), ("mixedscript", "IMPORTANT", "ВАЖНО", "ru_RU", False),
    ("nearmiss", "NOTE this", "NOE this", "fr", True), ("nearmiss", "MFA", "AMF", "fr", False), ("nearmiss", "DNSSEC key", "DNSEC key", "fr", True), ("nearmiss", "NOTE", "NOTA", "es", False),
    ("literalmask", "use YYYYMMDDnn", "use AAAAMMJJnn", "fr", True), ("literalmask", "DS and SSH", "x", "fr", False),
    ("protocoldowngrade", "https only", "http only", "fr", True), ("protocoldowngrade", "IPv6 address", "IPv4 address", "fr", True), ("protocoldowngrade", "https", "rien", "fr", False),
    ("ipliteral", "192.0.2.0/24", "192.0.2/24", "fr", True), ("ipliteral", "0.0.0.0", "0.0.0", "fr", False), ("ipliteral", "fec0::/10", "fec0:/10", "fr", True), ("ipliteral", "192.0.2.1", "nada", "fr", False),
    ("fragment_punctuation", "(ID", "(ID)", "fr", True), ("fragment_punctuation", "delete the", "supprimer ?", "fr", True), ("fragment_punctuation", "How it works", "Comment ?", "fr", False),
    ("escape_artifact", "x", 'x \\"', "zh_CN", True), ("unlocalized", "Edit zone metadata", "Redaktirovat metadannye", "ru_RU", True), ("unlocalized", "API URL", "URL API", "ru_RU", False),
    ("repetition", "x", "a a a a a a b", "fr", True), ("numerals", "1,000,000 rows", "1.000.000 rows", "de", False), ("numerals", "240-255", "from 240 to 255", "fr", False),
    ("numerals", "port 8080", "port", "fr", True), ("numerals", "value 42", "مقدار ۴۲", "fa_IR", False), ("truncation", "a b c d e f g h i j k l", "abc", "fr", True),
    ("truncation", "a b c d e f g h i j k l", "abc", "zh_CN", False), ("rrtype", "the TXT record", "le record", "fr", True), ("negation_loss", "do not stop", "arrêter", "fr", True),
    ("negation_loss", "do not stop", "ne pas arrêter", "fr", False), ("englishleak", "keys and settings", "ключи settings", "ru_RU", True), ("englishleak", "keys and settings", "ключи", "ru_RU", False),
]


def test_row_checks(spark):
    rows = [(i, loc, s, d) for i, (_, s, d, loc, _) in enumerate(CASES)] + [(len(CASES), "fr", None, None)]
    got = {r.pos: r for r in checks.flagged(spark.createDataFrame(rows, "pos long, locale string, src string, dst string")).collect()}
    wrong = [(c, s, d) for i, (c, s, d, _, want) in enumerate(CASES) if got[i][f"is_{c}"] != want]
    assert not wrong
    assert not any(got[len(CASES)][f"is_{n}"] for n in checks.ROW_CHECKS)


def test_findings_and_exit_code(spark):
    pairs = spark.createDataFrame([(1, "fr", "%s", "x"), (2, "fr", "a", "b")], "pos long, locale string, src string, dst string")
    found = checks.findings(pairs, ["placeholder", "tags"])
    assert [(r.cls, r.pos) for r in found.collect()] == [("placeholder", 1)]
    none = found.filter("false")
    assert (reports.exit_code(found, found), reports.exit_code(found, none), reports.exit_code(found, found.filter("NOT hard"))) == (1, 0, 0)
    assert reports.exit_code(none, none) == 2 and reports.exit_code(found, found, found) == 2


def pairs_of(spark, rows):
    return spark.createDataFrame([(i, "fr", s, d) for i, (s, d) in enumerate(rows)], "pos long, locale string, src string, dst string")


def test_antonyms(spark):
    df = pairs_of(spark, [("Set as default", "x"), ("Unset as default", "x"), ("Server Running", "y"), ("Server Not Running", "y"), ("Enable", "z"), ("Disable now", "z")])
    assert {(min(r.pos_a, r.pos_b), r.relation) for r in checks.antonym_collisions(df).collect()} == {(0, "swap"), (2, "negation")}


def test_collapse(spark):
    df = pairs_of(spark, [("Failed to bind to server", "Echec de l'opération sur le serveur"), ("Failed to connect to server", "Echec de l'opération sur le serveur"), ("has one record here", "un enregistrement ici présent"), ("have one record here", "un enregistrement ici présent")])
    assert [r.dst for r in checks.msgstr_collapses(df).collect()] == ["Echec de l'opération sur le serveur"]


def test_collapse_by_brute_force(spark):
    import itertools
    import random

    rng = random.Random(6)
    verbs, nouns, dsts = ["delete", "remove", "add", "show", "has", "have"], ["zone", "record", "user", "server"], ["ok\nune", "une phrase bien plus longue que les autres, vraiment", "et une autre\nqui est assez longue aussi, sans doute"]
    rows = [(f"{rng.choice(verbs)} the {rng.choice(nouns)} in this list", rng.choice(dsts) + str(rng.randrange(6))) for _ in range(60)]
    keys = {s: s.replace("the ", "").split() for s, _ in rows}
    ratios = sorted(len(d) / len(s) for s, d in rows)
    median = (ratios[29] + ratios[30]) / 2
    same = {frozenset(x) for x in (("delete", "remove"), ("has", "have"))}
    want = {}
    for d in {d for _, d in rows}:
        own = [s for s, x in rows if x == d]
        if len(own) < 2 or len({tuple(keys[s]) for s in own}) < 2:
            continue
        pressed = len(d) < 0.6 * median * min(map(len, own))
        differ = [[(x, y) for x, y in zip(keys[a], keys[b], strict=True) if x != y] for a, b in itertools.combinations(own, 2)]
        swapped = any(len(w) == 1 and frozenset(w[0]) not in same for w in differ)
        if pressed or swapped:
            want[d] = (len(own), pressed)
    got = {r.dst: (r.n, r.pressed) for r in checks.msgstr_collapses(pairs_of(spark, rows)).collect()}
    assert got == want and any(not p for _, p in want.values()) and any(p for _, p in want.values())


def test_leaked_sentinels():
    source = "%s of {name}"
    for leaked in ("ZZ0ZZ et ZZ1ZZ", "ZZ0Z et Z1Z", "Z0ZZZ et ZZ1", '"\u2022 0" et \u2022 1', '"0" et 1 \u2022', "zx 0 XZ et ZX1XZ"):
        assert similarity.unmask(leaked, similarity.mask(source)[1]) == "%s et {name}"
    assert similarity.unmask("ZZ7ZZ", ["%s"]) == "ZZ7ZZ" and similarity.unmask("ZZ0ZZ", []) == "ZZ0ZZ"


def test_crosswire_band(spark):
    rows = [("Alpha Beta 77", "Gamma Delta 99"), ("plain", "plain"), ("Gamma Delta 99", "Alpha Beta 77")] + [("x", "y")] * 200 + [("Gamma Delta 99", "none")]
    assert {r.pos for r in checks.crosswires(pairs_of(spark, rows)).collect()} == {0, 2}


def test_diacritics(spark):
    rows = [("s", "métadonnées réseau")] * 12 + [("s", "metadonnees reseau"), ("s", "reseau et château"), ("s", "autre")]
    assert {r.pos for r in diacritics.diacritics(pairs_of(spark, rows)).collect()} == {12, 13}


def test_mojibake(spark):
    df = spark.createDataFrame([("cafÃ© Â© Ãx",)], "t string")
    assert df.select(checks.repaired_mojibake(C("t")).alias("r")).first().r == "café © Ãx"


def test_plural_rules(spark):
    assert plural.equivalent(spark, "n != 1", "n == 1 ? 0 : 1") and not plural.equivalent(spark, "n > 1", "n != 1")
    assert plural.header_parts("nplurals=2; plural=(n > 1);") == (2, "(n > 1)")
    for bad in ("n; import os", "__import__", "n ? 1"):
        with pytest.raises(ValueError):
            plural.rule_sql(bad)


def test_escapes(spark):
    df = spark.createDataFrame([('a\\\\n "x"\n',)], "t string")
    row = df.select(T.escape_po(C("t")).alias("e"), T.unescape_po(T.escape_po(C("t")), single_pass=True).alias("u")).first()
    assert row.u == 'a\\\\n "x"\n'


def test_sentinels():
    masked, found = similarity.mask("Save %s in <b>[X]</b> {y}")
    assert found == ["%s", "<b>", "</b>", "{y}"] and similarity.unmask(masked.lower().replace("x", " x "), found) == "save %s in <b>[ x ]</b> {y}"


def test_registry_diff_and_services(spark):
    old = spark.createDataFrame([("COM", "http://a"), ("net", "https://b"), ("org", None)], "k string, v string")
    new = spark.createDataFrame([("com", "https://a"), ("dev", "https://d"), ("org", None)], "k string, v string")
    got = {r.key: r.status for r in relational.registry_diff(old, new, "k", "v", T.https_url(C("v"))).collect()}
    assert got == {"com": "unchanged", "net": "removed", "dev": "added", "org": "unchanged"}
    body = spark.createDataFrame([('{"services": [[["a", "B"], ["http://x/", "https://y/"]]]}',)], "b string")
    assert {r.key: r.url for r in registry.services(body, "b").collect()} == {"a": "https://x/", "b": "https://x/"}
    text = registry.as_array_file(spark.createDataFrame([("b", "2"), ("a", "1")], "k string, v string"), "k", "v", "test")
    assert [(r.key, r.value) for r in registry.array_file(text, "value").collect()] == [("a", "1"), ("b", "2")]


def test_review_is_all_or_nothing(spark):
    entries = spark.createDataFrame([("fr", "Save %s", "x", ["fuzzy"]), ("de", "Save %s", "y", ["fuzzy"])], "locale string, msgid string, msgstr string, flags array<string>")
    fixes = spark.createDataFrame([("fr", "Save %s", "Sauver %s"), ("de", "Save %s", "Sichern"), ("de", "Gone", "Weg")], "locale string, msgid string, text string")
    done, problems = rewrite.reviewed(entries, fixes)
    assert {r.locale: (r.msgstr, r.flags) for r in done.collect()} == {"fr": ("Sauver %s", []), "de": ("y", ["fuzzy"])}
    assert {(r.msgid, tuple(r.reasons)) for r in problems.collect()} == {("Save %s", ("placeholders",)), ("Gone", ("unknown",))}


def test_rules_and_years(spark):
    df = spark.createDataFrame([("license", "the thing"), ("other", "the thing"), ("the thing", "the thing")], "src string, dst string").withColumn("locale", F.lit("en"))
    rules = [rewrite.Rule("en", "the ([a-z])", r"\1", include="license"), rewrite.Rule("de", "t", "d")]
    assert [r.new_dst for r in rewrite.rewritten(df, rules).collect()] == ["thing", "the thing", "the thing"]
    years = spark.createDataFrame([("Copyright 2019-2025 X",), ("Copyright 2025 X",), ("Copyright 2024 X",)], "t string")
    assert [r[0] for r in years.select(rewrite.year_rolled(C("t"), 2026)).collect()] == ["Copyright 2019-2026 X", "Copyright 2026 X", "Copyright 2024 X"]
    text = spark.createDataFrame([("a the the the b bon bon!",)], "t string")
    assert text.select(T.collapse_repeats(C("t"))).first()[0] == "a the b bon!"


def test_exclusions(spark):
    df = spark.createDataFrame([("API",), ("api url",), ("DNS2",), ("Zone",), ("",)], "t string")
    assert [r[0] for r in df.select(stats.is_excluded(C("t"), ["API", "URL"])).collect()] == [True, True, True, False, False]


def test_flattened_and_templates(spark):
    df = spark.createDataFrame([('{"a": {"b": 1, "c": {"d": "x"}}, "e": 2}',)], "j string")
    assert {r.path for r in registry.flattened(df, "j").collect()} == {"a.b", "a.c.d", "e"}
    lines = spark.createDataFrame([("t.html", 1, "{% trans 'Hello ' %} {{ \"Bye\"|trans }}")], "path string, line int, text string")
    assert sorted(r.msgid for r in registry.template_strings(lines, "path", "line", "text").collect()) == ["Bye", "Hello"]


def test_streamed_findings(spark, tmp_path):
    from tesserae.streaming.checking import checked

    pairs_of(spark, [("%s", "x"), ("a", "b")]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("pos long, locale string, src string, dst string").parquet(str(tmp_path / "in"))
    seen = []
    checked(stream, lambda df, _: seen.extend(df.collect()), str(tmp_path / "c"), ["placeholder"]).awaitTermination()
    assert [r.pos for r in seen] == [0]


def test_hidden_characters_by_category_and_locale(spark):
    text = "a​‌᠎­‪⁩⁣\U000e0041\x07\x0b\x1c\x7f‎ \x93 z"
    rows = [(i, loc, "s", text) for i, loc in enumerate(["fr_FR", "fa_IR", "fa", None])] + [(9, "de_DE", "s", None)]
    got = checks.hidden_characters(spark.createDataFrame(rows, "pos int, locale string, src string, dst string")).collect()
    found = {loc: {(r.category, int(r.code, 16)) for r in got if r.locale == loc} for loc in ("fr_FR", "fa_IR", "fa", None)}
    every = {
        ("zero_width", 0x200B), ("zero_width", 0x200C), ("zero_width", 0x180E), ("soft_hyphen", 0xAD), ("bidi_control", 0x202A), ("bidi_control", 0x2069),
        ("invisible_math", 0x2063), ("tag_character", 0xE0041), ("ascii_control", 7), ("ascii_control", 0x7F),
    }
    assert found["fr_FR"] == found["fa"] == found[None] == every and found["fa_IR"] == every - {("zero_width", 0x200C)}


def test_correct_text_is_no_mojibake(spark):
    fine = ["déjà vu", "Ê la", "Ää", "Ã", "naïve ", "ÃÃ©"]
    broken = {"cafÃ©": "café", "Â©Â®": "©®", "Å\u0093uvre": "œuvre", "Ä\u0085": "ą"}
    df = spark.createDataFrame([(t,) for t in [*fine, *broken]], "t string")
    got = {r.t: (r.r, r.n) for r in df.select("t", checks.repaired_mojibake(C("t")).alias("r"), F.size(checks.mojibake_in(C("t"))).alias("n")).collect()}
    assert all(got[t] == (t, 0) for t in fine) and {t: got[t][0] for t in broken} == broken


def test_repetition_takes_the_first_of_equals(spark):
    from collections import Counter

    rng = random.Random(1)
    texts = ["in foo " * 6, "foo in " * 6, "a b " * 20, "", "a " * 5, "a " * 6, "aa a " * 6 + "x y z", "日 本 日 本 日 日 日 日 x"]
    texts += [" ".join(rng.choice(["in", "of", "foo", "a"]) for _ in range(rng.randint(1, 20))) for _ in range(300)]
    flags = {}
    for t in texts:
        words = t.split()
        token, n = Counter(words).most_common(1)[0] if words else ("", 0)
        flags[t] = len(words) >= 6 and len(token) <= 2 and n >= 6 and n >= len(words) * 0.4
    rows = checks.flagged(pairs_of(spark, [("x", t) for t in texts]), ["repetition"]).collect()
    assert {r.dst: r.is_repetition for r in rows} == flags and 10 < sum(flags.values()) < 300


def test_checks_take_inputs(spark):
    rows = [("Do not stop", "nem all"), ("Do not stop", "all"), ("mode p=none set", "all"), ('say "no"', "all"), ("no key", "(No key)")]
    df = pairs_of(spark, rows).withColumn("locale", F.lit("hu_HU"))
    hit = lambda given: [r.pos for r in checks.flagged(df, ["negation_loss"], {"negation_loss": given}).filter("is_negation_loss").orderBy("pos").collect()]
    assert hit({}) == [] and hit({"markers": {"hu": "nem -tlan"}}) == [1] and hit({"markers": {"hu_HU": "xx", "hu": "nem"}}) == [0, 1]
    df = pairs_of(spark, [("enter the mumble settings", "настройки mumble"), ("zone users", "zone users")]).withColumn("locale", F.lit("ru_RU"))
    leak = lambda given: [r.pos for r in checks.flagged(df, ["englishleak"], {"englishleak": given}).filter("is_englishleak").collect()]
    assert leak({}) == [1] and leak({"prose": ("mumble",)}) == [0]
    df = pairs_of(spark, [("x", "see Brand+ now"), ("x", "زیرنویس فارسی")])
    chrome = lambda given: [r.pos for r in checks.flagged(df, ["boilerplate"], {"boilerplate": given}).filter("is_boilerplate").collect()]
    assert chrome({}) == [1] and sorted(chrome({"phrases": ("Brand+",)})) == [0, 1]


@pytest.mark.parametrize(("markers", "clitic", "yes", "no"), [("nem", False, "ez nem jó", "nemes"), ("ne-", False, "Nemáte", "jine"), ("-maton", False, "tukematon", "matoni"), ("-me-", False, "gelmedi", "gel"), ("不", True, "我不是", "我是")])
def test_negation_patterns(spark, markers, clitic, yes, no):
    row = spark.createDataFrame([(yes, no)], "y string, n string").select(C("y").rlike(T.negation_pattern(markers, clitic)), C("n").rlike(T.negation_pattern(markers, clitic))).first()
    assert tuple(row) == (True, False)


def test_gate_with_old_texts_and_terms(spark):
    rows = [("Use DNSSEC / x", "Use dnssec/X", "Use it"), ("Zone", "zona", "Zone"), ("a term here", "egy", "b"), ("x", " ", None)]
    df = spark.createDataFrame([(i, "hu_HU", *r) for i, r in enumerate(rows)], "pos int, locale string, src string, dst string, old string")
    got = {r.pos: r.reasons for r in checks.gated(df, literals=["DNSSEC", ("term", ["de_DE"])], old="old").collect()}
    assert got == {1: "fallback", 2: "literals", 3: "leading_space|trailing_space|empty"}
    exempt = checks.gated(df, literals=[("term", ["hu_HU"])], old=None).collect()
    assert {r.pos for r in exempt} == {3}


def test_antonyms_in_a_hot_block(spark):
    """Many sources with one translation: only opposites meet, with the numbers of rows they stand for."""
    rows = [(f"Plain source number {chr(97 + i % 26)} {'x' * (i % 40)}", "one translation") for i in range(400)]
    rows += [("Enable it", "one translation"), ("enable it!", "one translation"), ("Disable it", "one translation"), ("Server running", "one translation"), ("Server not running", "one translation")]
    got = {(r.pos_a, r.pos_b, r.n_a, r.n_b, r.relation) for r in checks.antonym_collisions(pairs_of(spark, rows)).collect()}
    assert got == {(400, 402, 2, 1, "swap"), (403, 404, 1, 1, "negation")}


def test_antonyms_against_all_pairs(spark):
    """Each pair of sources that oppose each other and share a translation is found, with its relation and texts."""
    rng = random.Random(5)
    vocabulary = "enable disable undisable show hide unhide unshow active inactive unactive able unable zone unzone disunzone not never the x".split()
    targets = ["", "Voir", " Voir\u00a0", "Voir tout", "Une traduction assez", "Une traduction assez longue", "Une traduction assez courte", "Une traduction a"]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 2, 3, 3, 4, 4, 5)))), rng.choice(targets)) for _ in range(300)]
    base = " ".join(rng.choices(vocabulary, k=30))
    for k in (3, 23, 24, 25, 30):  # longer ones, of which the shorter or the longer has the marked word, on both sides of a head
        rows += [(f"{x} {' '.join(base.split()[:k])}", t) for x in ("enable", "disable") for t in targets[3:6]]
    pairs = pairs_of(spark, rows)
    sides = pairs.groupBy(T.strip(C("dst")).alias("t"), T.english_words(C("src")).alias("words")).agg(F.min("pos").alias("pos"), F.count("*").alias("n"))
    a, b = (sides.select(*[C(c).alias(f"{c}_{name}") for c in ("pos", "t", "words", "n")]) for name in "ab")
    both = a.crossJoin(b).filter("pos_a < pos_b").withColumn("relation", T.polarity(C("words_a"), C("words_b")))
    both = both.filter(C("relation").isNotNull() & T.shared_translation(C("t_a"), C("t_b"), C("relation")))
    columns = ["pos_a", "pos_b", "n_a", "n_b", "relation", "t_a", "t_b", "words_a", "words_b"]
    expected, got = (sorted(map(tuple, df.select(*columns).collect())) for df in (both, checks.antonym_collisions(pairs)))
    assert got == expected and {r[4] for r in got} == {"swap", "extended", "negation"} and any(r[5] != r[6] for r in got)


def test_report_lines(spark):
    rows = spark.createDataFrame([("fr_FR", 7, 95.25), ("a_very_long_locale", 123456789, None)], "locale string, total int, pct double")
    columns = [("locale", 8), ("total", -6), ("pct", -5)]
    assert [r.line for r in reports.table_lines(rows, columns, [F.desc("locale")]).collect()] == ["fr_FR    |      7 | 95.25", "a_very_long_locale | 123456789 |"]
    assert reports.heading(columns) == ["locale   |  total |   pct", "---------|--------|------"]
    found = spark.createDataFrame([(k, "tags" if k % 3 else "rrtype", bool(k % 3), "s" * 100, None) for k in range(10)], "pos int, cls string, hard boolean, src string, dst string")
    got = reports.examples(found, ["cls"], "pos", 2).collect()
    assert sorted((r.cls, r.pos, r.place, r["of"], len(r.src)) for r in got) == [("rrtype", 0, 1, 4, 88), ("rrtype", 3, 2, 4, 88), ("tags", 1, 1, 6, 88), ("tags", 2, 2, 6, 88)]
    assert reports.examples(found, ["cls"], "pos", 0).count() == 10
    assert [r.line for r in reports.class_totals(found).collect()] == ["    tags" + " " * 16 + "     6", "    rrtype" + " " * 14 + "     4  (soft)"]


def test_coverage_counts(spark):
    rows = [("fr", "A b c", "A b c", True, False), ("fr", "A b c", "A b c", False, False), ("fr", "A b", "A b", False, False), ("fr", "x y", "z", None, None), ("fr", "x", "", False, False), ("fr", "gone", "g", False, True), ("de", "API", "API", False, False)]
    df = spark.createDataFrame(rows, "locale string, src string, dst string, f boolean, o boolean")
    got = {r.locale: tuple(r)[1:] for r in stats.coverage(df, ["API"], C("f"), C("o")).collect()}
    assert got == {"fr": (5, 4, 1, 1, 1, 1, 20.0), "de": (0, 0, 0, 0, 0, 0, None)}
    assert [r.locale for r in stats.reported(stats.coverage(df, ["API"], C("f"), C("o"))).collect()] == ["fr"]
