import gettext
import io

from tesserae.operators import catalogue
from tesserae.sources import files, mo, php, po

CATALOGUE = 'msgid ""\nmsgstr "Content-Type: text/plain; charset=UTF-8\\n"\n"Plural-Forms: nplurals=2; plural=n > 1;\\n"\n\nmsgid "a"\nmsgstr "é"\n\n#, fuzzy\nmsgid "f"\nmsgstr "x"\n\nmsgid "one"\nmsgid_plural "many"\nmsgstr[0] "un"\nmsgstr[1] "des"\n'


def test_compiled_catalogue(spark, tmp_path):
    (tmp_path / "fr").mkdir()
    (tmp_path / "fr" / "messages.po").write_text(CATALOGUE, encoding="utf-8")
    raw = mo.compiled(po.read_po(spark, f"{tmp_path}/fr/*.po")).first().content
    t = gettext.GNUTranslations(io.BytesIO(bytes(raw)))
    assert t.gettext("a") == "é" and t.gettext("f") == "f" and t.ngettext("one", "many", 3) == "des"
    assert mo.read(bytes(raw))["one\0many"] == "un\0des"


def test_scans(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.php").write_text("<?php // License X\n\npublic const MX = 'MX';\npublic const A = 'B';\ndefine('VERSION', '4.1.0');\necho _('Save') . ngettext(\"one\", 'many', 2);\n")
    (tmp_path / "src" / "b.php").write_bytes(b"\xff\xfe bad")
    (tmp_path / "src" / "c.txt").write_text("skip")
    (tmp_path / "OUT_fr_rev2.json").write_text('{"a": "b"}')
    (tmp_path / "tlds.txt").write_text("# Version\nCOM\nnet\n\nCOM\n")
    (tmp_path / "log.txt").write_text("x.po:12: error\nx.po:13: warning: y\n")
    own = files.whole_files(spark, str(tmp_path / "src"), "*.php")
    text = files.texts(own)
    assert [r.path[-5:] for r in files.invalid(own).collect()] == ["b.php"]
    assert [r.name for r in catalogue.constants(text, "text").collect()] == ["MX"]
    assert [r.version for r in files.versions(text).collect()] == ["4.1.0"]
    assert sorted((r.msgid, r.line) for r in php.translated_strings(text).collect()) == [("Save", 6), ("one", 6)]
    assert files.without_marker(text, "License").count() == 0 and files.older_than(text, 1).count() == 0
    assert [tuple(r) for r in files.proposals(spark, f"{tmp_path}/OUT_*.json").collect()] == [("fr", "rev", "a", "b")]
    assert sorted(r.name for r in files.list_entries(spark, f"{tmp_path}/tlds.txt").collect()) == ["com", "net"]
    assert [r.line for r in files.diagnostics(spark, f"{tmp_path}/log.txt").collect()] == [12]


def test_a_walk_prunes_folders(spark, tmp_path):
    for name, text in {"a/x.php": "1", "a/.git/y.php": "2", "b/vendor/z/w.php": "3", "b/big.php": "4" * 100, "b/i.png": "5", "b/c/d.txt": "6"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    found = files.walked(spark, str(tmp_path), (".git", "vendor"), (".png",), most=50)
    assert sorted(r.path.split("/")[-1] for r in found.collect()) == ["d.txt", "x.php"]


def test_strict_compile(spark, tmp_path):
    for locale, text in {"ok": 'msgid "a\\n"\nmsgstr "b\\n"\n', "bad": 'msgid "a\\n"\nmsgstr "b"\n', "twice": 'msgid "a"\nmsgstr "b"\n\nmsgid "a"\nmsgstr "c"\n', "fuzzy": '#, fuzzy\nmsgid "a\\n"\nmsgstr "b"\n\nmsgid "k"\nmsgstr "v"\n'}.items():
        (tmp_path / locale).mkdir()
        (tmp_path / locale / "m.po").write_text(text)
    entries = po.read_po(spark, f"{tmp_path}/*/m.po")
    assert sorted((r.path.split("/")[-2], r.pos, r.fault) for r in mo.faults(entries).collect()) == [("bad", 0, "newline"), ("twice", 1, "duplicate")]
    assert sorted(r.path.split("/")[-2] for r in mo.compiled(entries, strict=True).collect()) == ["fuzzy", "ok"]
    assert {(r.key, r.value) for r in mo.decoded(mo.compiled(entries).filter("path LIKE '%twice%'")).collect()} == {("a", "c")}


def test_flags_of_a_rewritten_block():
    raw = "# note\n#: a.php:1\n#: b.php:2\nmsgid \"a\"\nmsgstr \"\""
    assert po.render(raw, "", True, "b", {}, ["auto-english-fallback"]) == "# note\n#: a.php:1\n#: b.php:2\n#, auto-english-fallback\nmsgid \"a\"\nmsgstr \"b\""
    assert po.render("msgid \"a\"\nmsgstr \"\"", "\n", True, "b", {}, ["x", "y"]) == "#, x, y\nmsgid \"a\"\nmsgstr \"b\"\n"
    assert po.render("#, fuzzy\n" + raw, "", True, "b", {}, []) == raw[:-1] + "b\""
