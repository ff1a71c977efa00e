"""Large catalogues: work and memory grow with the file."""

import time
import tracemalloc

from tesserae.sources import mo, po, pot


def test_compiling_is_linear():
    entries = [(f"key {k} " + "x" * 40, f"value {k} " + "y" * 40) for k in range(60_000)]
    begun = time.process_time()
    raw = mo.compile_entries(entries)
    assert time.process_time() - begun < 3
    assert mo.read(raw) == dict(entries)


def test_parsing_holds_an_entry_at_a_time():
    text = "".join(f'#: a.php:{k}\nmsgid "source {k}"\nmsgstr "text {k}"\n\n' for k in range(20_000))
    tracemalloc.start()
    n = sum(1 for _ in po.rows("de_DE/x.po", text))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 20_000 and peak < len(text)


def test_templates_are_cut_into_files(spark, tmp_path):
    """No file of a template grows with the table, and what is read back is whole and in order."""
    rows = spark.range(50).selectExpr("format_string('text %02d', id) AS msgid", "'a.php' AS path", "id AS line")
    pot.write_template(pot.template(rows), f"{tmp_path}/out", pot.license_head("P", 2026, "H"), [("Language", "en_EN")], parts=2, most=7)
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len(files) >= 8 and max(p.read_text().count("msgid ") for p in files) <= 7
    got = pot.read_template(spark, f"{tmp_path}/out").orderBy("path", "pos").collect()
    assert got[0].is_header and [r.msgid for r in got[1:]] == [f"text {k:02d}" for k in range(50)]
