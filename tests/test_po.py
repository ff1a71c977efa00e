import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tesserae.sources import po

CATALOGUE = '''# Head
msgid ""
msgstr ""
"Language: fr\\n"
"Plural-Forms: nplurals=2; plural=n > 1;\\n"

#: a.php:3 b.php:4
#, fuzzy, c-format
msgctxt "menu"
msgid "Save %s"
msgstr "Enregistrer %s"

msgid "one zone"
msgid_plural "%d zones"
msgstr[0] "une zone"
msgstr[1] ""


#~ msgid "old"
#~ msgstr "vieux"

# only a comment

msgid "two\\nlines"
msgstr ""
"deux\\n"
"lignes 𝄞"
   
'''


def test_parse_and_render():
    entries = po.parse(CATALOGUE)
    assert "".join(e.raw + e.sep for e in entries) == CATALOGUE
    assert entries[1].fields == {"msgctxt": "menu", "msgid": "Save %s", "msgstr": "Enregistrer %s"}
    assert entries[1].flags == ["fuzzy", "c-format"] and entries[1].locations == ["a.php:3", "b.php:4"]
    assert entries[2].plurals == {0: "une zone", 1: ""}
    assert entries[3].obsolete and entries[3].obsolete_msgid == "old"
    assert entries[5].fields["msgstr"] == "deux\nlignes 𝄞"
    assert po.render(entries[1].raw, "\n", True, "Sauver %s", {}, []) .endswith('msgid "Save %s"\nmsgstr "Sauver %s"\n')


@given(st.text())
@settings(max_examples=200, deadline=None)
def test_blocks_cover_text(text):
    assert "".join(a + b for a, b in po.split_blocks(text)) == text


@given(st.text(alphabet='ab"\n\t', max_size=30))
@settings(max_examples=200, deadline=None)
def test_strings_round_trip(text):
    block = po.as_text("msgid", "x") + "\n" + po.as_text("msgstr", text)
    assert po.parse_block(block).fields.get("msgstr") == text


def test_sources_and_sink(spark, tmp_path):
    folder = tmp_path / "locale" / "fr" / "LC_MESSAGES"
    os.makedirs(folder)
    (folder / "messages.po").write_text(CATALOGUE, encoding="utf-8")
    spark.dataSource.register(po.PoSource)
    a = spark.read.format("po").load(str(tmp_path / "locale"))
    b = po.read_po(spark, f"{tmp_path}/locale/*/LC_MESSAGES/*.po")
    for df in (a, b):
        got = df.orderBy("pos").collect()
        assert [r.is_header for r in got] == [True, False, False, False, False, False]
        assert {r.locale for r in got} == {"fr"} and got[1].is_fuzzy
        assert got[2].line_start == 1 + CATALOGUE[: CATALOGUE.index('msgid "one')].count("\n")
        text = po.catalogue_text(df.withColumn("dirty", F.lit(False))).first().content
        assert text == CATALOGUE
    assert sorted((r.form, r.src, r.dst) for r in po.views(b).collect()) == [(-1, "Save %s", "Enregistrer %s"), (-1, "two\nlines", "deux\nlignes 𝄞"), (0, "one zone", "une zone")]
