"""Marks, ordered operators, resumable batches, verified rewrites, rules and documents as data, PHP strings, templates and gates on small cases."""

import json
import random
import unicodedata
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tesserae.functions.similarity import SPELT_OUT
from tesserae.operators import diacritics, inspection, ordered, publishing, relational, resumable, rule_tables
from tesserae.sources import json_documents, php, pot
from tesserae.sources.shared import shared_dir

C = F.col


# --- marks -------------------------------------------------------------------------------


def brute_marks(rows, literals=()):
    """Entries with damaged words, by counting all spellings of a locale."""
    import re

    find = re.compile(r"[^\W\d_]{3,}").findall
    fold = str.casefold
    plain = lambda w: "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c)).casefold()
    spelt = lambda w: w.translate(SPELT_OUT).casefold()
    bare = lambda w: fold(w) == plain(w) == spelt(w)
    out = {}
    for locale in {r[0] for r in rows}:
        own, seen = [r for r in rows if r[0] == locale], defaultdict(Counter)
        for _, _, _, dst in own:
            for w in find(dst):
                seen[plain(w)][w] += 1
                if spelt(w) != fold(w):
                    seen[spelt(w)][w] += 1
        count = lambda w: (sum(n for x, n in seen[fold(w)].items() if bare(x)), sum(n for x, n in seen[fold(w)].items() if not bare(x)))  # noqa: B023, E731
        suspects = {}
        for _, pos, src, dst in own:
            known = {plain(w) for w in find(src)}
            suspects[pos] = {w for w in find(dst) if bare(w) and w not in literals and plain(w) not in known and count(w)[1] and count(w)[1] >= count(w)[0]}
        damaged = set()
        for _, pos, _, dst in own:
            strong = [w for w in suspects[pos] if count(w)[1] >= 5 and count(w)[1] >= 5 * count(w)[0]]
            if len(strong) >= 2 and all(map(bare, find(dst))):
                damaged |= {fold(w) for w in suspects[pos]}
        for pos, ws in suspects.items():
            if hit := sorted({fold(w) for w in ws} & damaged):
                out[locale, pos] = hit
    return out


@pytest.mark.parametrize("seed", range(3))
def test_lost_marks(spark, seed):
    rng = random.Random(seed)
    lexicon = ["für", "müssen", "Größe", "straße", "métadonnées", "réseau", "château", "ασφάλεια", "δεδομένα", "новый", "край", "zone", "Å­rhus"[:1] + "rhus", "utilisé", "한국어", "naïve"]
    strip = lambda w: "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c))
    rows = []
    for i in range(220):
        words = [rng.choice(lexicon) for _ in range(rng.randint(1, 6))]
        how = rng.random()
        words = [strip(w) if how < 0.06 else w.translate(SPELT_OUT) if how < 0.12 else w for w in words]
        rows.append((rng.choice(["de", "xx"]), i, rng.choice(["", "zone Reseau", "the für"]), " ".join(words)))
    got = {(r.locale, r.pos): r.words for r in diacritics.diacritics(spark.createDataFrame(rows, "locale string, pos long, src string, dst string"), ("fuer",)).collect()}
    want = brute_marks(rows, ("fuer",))
    assert got == want and want


def test_spelt_out_umlauts(spark):
    rows = [("de", i, "s", "für müssen") for i in range(100, 130)] + [("de", 12, "s", "fuer muessen"), ("de", 13, "s", "fuer Wien für"), ("de", 14, "for fuer", "fuer muessen"), ("de", 15, None, None)]
    got = {r.pos: r.words for r in diacritics.diacritics(spark.createDataFrame(rows, "locale string, pos long, src string, dst string")).collect()}
    assert got == {12: ["fuer", "muessen"], 13: ["fuer"], 14: ["muessen"]}


# --- rows in order -----------------------------------------------------------------------


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_running_sums_and_carried_values(spark, block):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), k, rng.choice([None, k % 5]), rng.choice([None, f"v{k}"])) for k in rng.sample(range(-20, 200), 120)]
    df = spark.createDataFrame(rows, "path string, line long, n long, v string").repartition(3)
    out = ordered.carried(ordered.running_sums(df, ["path"], "line", {"before": C("n")}, block), ["path"], "line", {"last": C("v")}, block)
    for r in out.collect():
        earlier = sorted((x for x in rows if x[0] == r.path and x[1] <= r.line), key=lambda x: x[1])
        assert r.before == sum(x[2] or 0 for x in earlier if x[1] < r.line)
        assert r.last == next((x[3] for x in reversed(earlier) if x[3]), None)


def state_machine(lines):
    """msgid -> msgstr, line by line."""
    found, msgid, msgstr, on = {}, "", "", None
    for line in [*lines, None]:
        if line is None or line.startswith('msgid "') or (line == "" and msgid and msgstr):
            if msgid and msgstr:
                found[msgid.strip()] = msgstr.strip()
            if line is None:
                break
            msgid = msgstr = ""
        if line.startswith('msgid "'):
            msgid, on = line[6:], "id"
        elif line.startswith('msgstr "'):
            msgstr, on = line[7:], "str"
        elif line.startswith('"') and on == "id":
            msgid += "\n" + line
        elif line.startswith('"') and on == "str":
            msgstr += "\n" + line
        elif line == "":
            on = None
    found.pop('""', None)
    return found


@pytest.mark.parametrize("block", [2, 4096])
def test_quoted_map(spark, block):
    rng = random.Random(9)
    kinds = ['msgid "a"', 'msgid ""', 'msgid "b"', 'msgstr "x"', 'msgstr ""', '"more"', '"more\\n"', "", "# note", 'msgid_plural "p"', '  "indented"', 'msgstr[0] "f"']
    files = {p: ['msgid "first"', *(rng.choice(kinds) for _ in range(300))] for p in ("p", "q")}
    rows = [(p, n, t) for p, lines in files.items() for n, t in enumerate(lines)]
    got = defaultdict(dict)
    for r in ordered.quoted_map(spark.createDataFrame(rows, "path string, line long, text string").repartition(4), block=block).collect():
        got[r.path][r.msgid] = r.msgstr
    assert dict(got) == {p: state_machine(lines) for p, lines in files.items()}


def test_line_owners_over_many_blocks(spark):
    rows = [("f", k, "x\n" * (k % 4)) for k in range(6000)]
    spans = relational.line_spans(spark.createDataFrame(rows, "path string, pos long, text string"), "path", "pos", "text")
    owners, line = {}, 1
    for _, k, t in rows:
        for n in range(line, line + t.count("\n") + 1):
            owners[n] = k
        line += t.count("\n") + 1
    lines = spark.createDataFrame([("f", n) for n in (*range(1, line, 37), line + 500)], "path string, line long")
    got = {r.line: r.pos for r in relational.line_owners(lines, spans.select("path", "pos", "line_start"), "path", "line").collect()}
    assert got == {n: owners.get(n, 5999) for n in got} and len(got) > 100


# --- batches and versions ----------------------------------------------------------------


def test_a_killed_run_is_resumed(spark):
    wanted = spark.createDataFrame([(k,) for k in range(50)], "key long")
    ledger = resumable.Ledger(spark, shared_dir(spark), "key long, done string")
    seen = []

    def work(part):
        seen.append([r.key for r in part.collect()])
        if len(seen) == 3:
            # fails in a task, after other tasks of the batch may have ended
            return part.select("key", F.when(C("key") >= 0, F.raise_error(F.lit("killed")).cast("string")).alias("done"))
        return part.select("key", F.concat(F.lit("d"), C("key").cast("string")).alias("done"))

    with pytest.raises(Exception, match="killed"):
        resumable.resumed(wanted, ledger, "key", work, 5)
    done = {r.key for r in ledger.rows().collect()}
    assert done == set(seen[0]) | set(seen[1]) and 0 < len(done) < 50
    more = wanted.union(spark.createDataFrame([(99,)], "key long"))
    resumable.resumed(more, ledger, "key", work, 4)
    assert sorted(k for part in seen[3:] for k in part) == sorted({*range(50), 99} - done)
    assert Counter(r.key for r in ledger.rows().collect()) == Counter([*range(50), 99])
    assert resumable.resumed(more, ledger, "key", work, 4) == 0


def test_a_batch_delivered_twice_counts_once(spark, tmp_path):
    spark.range(40).write.parquet(str(tmp_path / "in"))
    ledger = resumable.Ledger(spark, str(tmp_path / "ledger"), "id long")
    add = ledger.sink(lambda batch: batch.filter("id % 2 = 0"))

    def twice(batch, number):
        add(batch, number)
        add(batch, number)

    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream.writeStream.foreachBatch(twice).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in ledger.rows().collect()) == list(range(0, 40, 2))


def test_a_failed_check_leaves_the_old_version(spark):
    store = publishing.Store(spark, shared_dir(spark))
    with pytest.raises(FileNotFoundError):
        store.read()
    store.publish(store.stage(spark.createDataFrame([("a", "x  "), ("b", "keep  "), ("c", "fine"), ("d", None)], "path string, content string")))
    first = store.current()
    fix = lambda c: F.when(c.startswith("keep"), c).otherwise(F.regexp_replace(c, " +$", ""))
    defects = lambda c: c.rlike(" $").cast("int")
    dry = {r.path: r.outcome for r in publishing.rewritten(store, "content", fix, defects, dry_run=True).collect()}
    assert dry == {"a": "would_fix", "b": "would_restore"} and store.current() == first
    report = {r.path: (r.before, r.after, r.outcome) for r in publishing.rewritten(store, "content", fix, defects).collect()}
    assert report == {"a": (1, 0, "fixed"), "b": (1, 1, "restored")}
    assert {r.path: r.content for r in store.read().collect()} == {"a": "x", "b": "keep  ", "c": "fine", "d": None}
    assert {r.path: r.content for r in store.read(first).collect()}["a"] == "x  " and len(store.published()) == 2
    with pytest.raises(Exception, match="boom"):
        publishing.rewritten(store, "content", lambda c: F.raise_error(F.lit("boom")).cast("string"), defects)
    assert len(store.published()) == 2
    half = store.stage(spark.range(1).toDF("x"))
    store.folder.drop(f"{half}/_SUCCESS")
    with pytest.raises(ValueError, match="end"):
        store.publish(half)
    clean = publishing.rewritten(store, "content", fix, lambda c: F.lit(0))
    assert clean.collect() == [] and len(store.published()) == 2


def test_changes_are_held_against_their_plan(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, v string, o int")
    before = frame(("same", "1", 1), ("fixed", "1", 1), ("wild", "1", 1), ("missed", "1", 1), ("lost", "1", 1), ("spilt", None, None), ("both", "1", 1))
    after = frame(("same", "1", 1), ("fixed", "2", 1), ("wild", None, 1), ("missed", "1", 1), ("new", "1", 1), ("spilt", None, 2), ("both", "2", 2))
    planned = spark.createDataFrame([("fixed",), ("fixed",), ("missed",)], "k string")
    got = sorted(map(tuple, relational.audited_changes(before, after, planned, "k", "v", ["o"]).collect()))
    assert got == [("both", "spilled"), ("both", "unexpected"), ("lost", "lost"), ("missed", "missed"), ("new", "new"), ("spilt", "spilled"), ("wild", "unexpected")]


def test_a_version_with_problems_is_not_published(spark):
    store = publishing.Store(spark, shared_dir(spark))
    rows = lambda *values: spark.createDataFrame(list(values), "k string, v string")
    store.publish(store.stage(rows(("a", "1"), ("b", "1"))))
    plan = spark.createDataFrame([("a",)], "k string")
    assert publishing.verified(store, rows(("a", "2"), ("b", "2")), plan, "k", "v").count() == 1 and len(store.published()) == 1
    assert publishing.verified(store, rows(("a", "2"), ("b", "1")), plan, "k", "v").count() == 0 and len(store.published()) == 2
    assert {r.k: r.v for r in store.read().collect()} == {"a": "2", "b": "1"}


# --- rules and documents -----------------------------------------------------------------


def test_rules_in_order(spark, tmp_path):
    mined = {"per_locale": {"ms_MY": {"rules": [{"pattern": "catatan", "replace": "rekod", "guard": {"include": "record", "exclude": "note"}}, {"pattern": "(re)(kod)", "replace": "\\2$\\1"}], "review_only": [{"wrong": "a", "right": "b", "source_term": "c", "why_not_mechanical": "d"}]}, "id_ID": {}}}
    (tmp_path / "mined.json").write_text(json.dumps(mined))
    text = rule_tables.read_mined(spark, str(tmp_path / "mined.json"))
    assert rule_tables.read_mined(spark, str(tmp_path / "none.json")).count() == 0
    curated = spark.createDataFrame([("ms_MY", "curated", 0, "buku", "catatan", None, None)], rule_tables.RULES)
    rules = rule_tables.in_order(curated, rule_tables.mined_rules(text))
    rows = [(1, "ms_MY", "A RECORD", "buku"), (2, "ms_MY", "record note", "buku"), (3, "ms_MY", "buku", " buku "), (4, "xx", "record", "buku"), (5, "ms_MY", "x", None)]
    got = {r.pos: (r.new_dst, r.changed) for r in rule_tables.corrected(spark.createDataFrame(rows, "pos int, locale string, src string, dst string"), rules).collect()}
    assert got == {1: ("kod$re", True), 2: ("catatan", True), 3: (" buku ", False), 4: ("buku", False), 5: (None, False)}
    assert [tuple(r) for r in rule_tables.review_only(text).collect()] == [("ms_MY", "a", "b", "c", "d")]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        rule_tables.mined_rules(spark.createDataFrame([('{"per_locale": [',)], "text string")).collect()


def docs_of(spark, *values):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values], "text string")


def test_json_documents(spark):
    assert {r.term for r in json_documents.exclusions(docs_of(spark, {"description": "x", "exclusions": ["API", "DNS", "API"]})).collect()} == {"API", "DNS"}
    assert [tuple(r) for r in json_documents.plural_rules(docs_of(spark, {"_meta": 1, "rules": {"fr": "nplurals=2; plural=n>1;"}})).collect()] == [("fr", "nplurals=2; plural=n>1;")]
    terms = json_documents.agreed_terms(docs_of(spark, {"_meta": {"a": 1}, "zone": {"fr": ["zone", "Zone"], "de": []}})).collect()
    assert sorted(map(tuple, terms)) == [("zone", "de", []), ("zone", "fr", ["zone", "Zone"])]
    own = json_documents.glossary(docs_of(spark, {"literal": [{"term": "A", "note": "n", "exempt_locales": ["fr"]}, {"term": "B"}]})).collect()
    assert sorted(map(tuple, own)) == [("A", "n", ["fr"]), ("B", None, [])]
    assert [tuple(r) for r in json_documents.services(docs_of(spark, {"services": [[["a", "b"], ["u"]]]})).collect()] == [(0, ["a", "b"], ["u"])]


@pytest.mark.parametrize("bad", ['{"services": [', "[]", '{"services": {}}', '{"services": [[["a"]]]}', '{"services": [[["a"], null]]}', '{"services": [{"a": 1}]}', None])
def test_documents_of_another_shape_fail(spark, bad):
    with pytest.raises(Exception, match="unexpected|CAST"):
        json_documents.services(docs_of(spark, {"services": []}, bad)).collect()


def test_json_fault_kinds(spark):
    values = ['{"a": 1, "b": [], "c": {}, "d": "s", "e": true, "f": null, "g": 1.5}', "nope", '{"a": "1"}', "{}"]
    shape = {"$.a": "number", "$.b": "array?", "$.c": "object?", "$.d": "string?", "$.e": "boolean?", "$.f": "null?", "$.g": "number?"}
    assert {r.text: r.fault for r in json_documents.faults(docs_of(spark, *values), "text", shape).collect()} == {"nope": "not JSON", '{"a": "1"}': "$.a: string", "{}": "$.a: absent"}
    with pytest.raises(ValueError, match="unknown"):
        json_documents.fault(C("text"), {"$": "list"})


# --- sources and templates ---------------------------------------------------------------

PHP = r"""<html>_('not PHP')
<?php
// _('comment') ?>_('nor this')<?php # _('comment')
/* _('comment
') */ echo _('It\'s "one" \n'); $x = $this->_('a method'); function _($s) { return _("tab\tnew\x41\u{e9}\101"); }
echo ngettext('one zone',
    "%d zones", count(_('inner')))
  . _( 'joined ' . "over " /* why */ .
    'lines' );
$y = <<<TEXT
_('heredoc')
TEXT;
echo _("has $variable"), _($variable), _("price \$5"), dngettext('domain', 'a', 'b', $n), _(strtolower('x')), _('last', 1); $a = ['_(' => "_('in a string')"];
?> _('after') <?= _('short') ?>"""


def test_php_strings(spark):
    rows = php.translated_strings(spark.createDataFrame([("f.php", PHP), ("empty.php", None), ("open.php", "<?php _('never ends")], "path string, text string")).collect()
    assert {r.path for r in rows} == {"f.php"}
    assert sorted((r.line, r.msgid, r.msgid_plural) for r in rows) == sorted([
        (5, 'It\'s "one" \\n', None), (5, "tab\tnewAéA", None), (6, "one zone", "%d zones"), (7, "inner", None), (8, "joined over lines", None),
        (13, "price $5", None), (13, "a", "b"), (13, "last", None), (14, "short", None),
    ])


def test_template_round_trip(spark, tmp_path):
    first = [("b\nc", None, "x.php", 3), ("dup", None, "x.php", 9), ('q"\\t\t', "many", "x.php", 2)]
    second = [("dup", "dups", "a.html", 1), ("", None, "a.html", 2), ("\nlead\n\ntrail\n", None, "a.html", 5), (" ", None, "a.html", 4)]
    schema = "msgid string, msgid_plural string, path string, line int"
    records = pot.template(spark.createDataFrame(first, schema), spark.createDataFrame(second, schema))
    folder = str(tmp_path / "out")
    pot.write_template(records, folder, pot.license_head("P", 2026, "H"), [("Language", "en_EN")], parts=3)
    got = pot.read_template(spark, folder).orderBy("path", "pos").collect()
    assert got[0].is_header and got[0].msgstr == "Language: en_EN\n" and got[0].is_fuzzy
    assert [(r.msgid, r.msgid_plural, r.locations) for r in got[1:]] == [
        ('q"\\t\t', "many", ["x.php:2"]), ("b\nc", "", ["x.php:3"]), ("dup", "dups", ["x.php:9", "a.html:1"]), (" ", "", ["a.html:4"]), ("\nlead\n\ntrail\n", "", ["a.html:5"]),
    ]
    text = "".join(open(p).read() for p in sorted(map(str, (tmp_path / "out").glob("part-*"))))
    assert text.startswith("# P translation template.") and text.count('msgid ""') == 3
    with pytest.raises(Exception, match="exists|EXISTS"):
        pot.write_template(records, folder, "", [])
    assert pot.problems(pot.read_template(spark, folder)).collect() == []
    lines = spark.createDataFrame([(x,) for x in ('msgid "b"', 'msgid ""', 'msgid "a"', 'msgid "b"', 'msgid_plural "c"', "x")], "text string")
    assert [r.line for r in pot.simplified(lines).collect()] == ['msgid "a"', 'msgid "b"', 'msgid_plural "c"']


# --- gates -------------------------------------------------------------------------------


def test_versions_sort(spark):
    order = ["0.9", "1", "1.0.1-alpha", "1.0.1-rc1", "v1.0.1", "1.2.9", "1.10.0-beta", "1.10", "2.0.0.0"]
    rows = spark.createDataFrame([(v,) for v in reversed(order)] + [("x",), ("1.2.x",), (None,)], "tag string").withColumn("k", inspection.version_key(C("tag")))
    assert [r.tag for r in rows.filter("k IS NOT NULL").orderBy("k").collect()] == order
    assert rows.filter("k IS NULL").count() == 3 and inspection.latest(rows).first().latest == "2.0.0.0"
    same = spark.createDataFrame([("1.2",), ("v1.2.0",)], "t string").select(inspection.version_key(C("t")).alias("k")).distinct()
    assert same.count() == 1


def test_release_gates(spark):
    frame = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    releases = frame("release int, branch string, version string", (1, "release/2.x", "v1.10.0"), (2, "topic", "1.2"), (3, None, "1.0-rc1"))
    gates = inspection.release_gates(
        releases, frame("release int, path string", (2, "x")), frame("release int, path string", (1, "a.php"), (2, ".env")), frame("path string", (".env",)),
        frame("release int, tag string", (1, "v1.9.9"), (1, "junk"), (2, "v1.2.0"), (3, "0.9")), frame("release int, path string", (1, "docs"), (1, "docs"), (3, "src")),
    )
    got = defaultdict(dict)
    for r in gates.collect():
        got[r.release][r.gate] = r.outcome
    assert got[1] == dict.fromkeys(("branch", "clean", "secrets", "folders", "version"), "pass")
    assert got[2] == {"branch": "warn", "clean": "fail", "secrets": "fail", "folders": "warn", "version": "fail"}
    assert got[3] == {"branch": "warn", "clean": "pass", "secrets": "pass", "folders": "warn", "version": "pass"}


def test_bypass_rules_by_brute_force(spark):
    import ipaddress

    rng = random.Random(2)
    hosts = [".".join(str(rng.choice([0, 1, 10, 127, 192, 255])) for _ in range(4)) for _ in range(60)] + ["a.b.test", "B.TEST", "x.a.b.test", "test", "256.1.1.1", "1.2.3", "ab.test", ""]
    rules = ["10.0.0.0/8", "0.0.0.0/0", "192.192.0.0/10", "127.0.0.1/32", "255.255.255.255", ".b.test", "*.test", "a.b.test", "*", "10.0.0.0/33", "300.0.0.0/8", "b.test"]

    def under(host, rule):
        host, name = host.lower(), rule.lower()
        if name == "*":
            return True
        try:
            return ipaddress.IPv4Address(host) in ipaddress.IPv4Network(name, strict=False)
        except ValueError:
            pass
        if name.startswith(("*.", ".")):
            end = name.lstrip("*")
            return host.endswith(end) or "." + host == end
        return host == name

    got = {(r.host, r.rule) for r in relational.bypassed(spark.createDataFrame([(h,) for h in hosts], "host string"), spark.createDataFrame([(r,) for r in rules], "rule string")).collect()}
    assert got == {(h.lower(), r) for h in hosts for r in rules if h and under(h, r)}
