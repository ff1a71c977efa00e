"""Queries that do their whole job: none of their input is left out, and what moves between tasks grows with it."""

import random

from pyspark.sql import functions as F

from tesserae.functions import text
from tesserae.operators import checks, diacritics, reports
from tesserae.plans import relational_queries


def shuffled(spark, work):
    """Bytes that the stages of some work write for others, and the work's result."""
    sc = spark.sparkContext

    def written():
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    before = written()
    out = work()
    return written() - before, out


def test_stale_entries_reads_all_orders(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(20, 1), (21, 2)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    assert [tuple(r) for r in relational_queries.stale_entries_anti(spark, str(tmp_path)).collect()] == [(3, "c")]


def _texts(n, words, seed):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices("abcdefghklmoprst", k=rng.randint(3, 9))) for _ in range(words)) for _ in range(n)]


def test_antonyms_move_few_words(spark):
    """Words that have no opposite in the locale stay where they are."""
    texts = _texts(40, 1500, 1)
    rows = [(2 * k + side, "fr", f"{word} {t}", t) for k, t in enumerate(texts) for side, word in enumerate(("Enable", "Disable"))]
    pairs = spark.createDataFrame(rows, "pos long, locale string, src string, dst string")
    size, found = shuffled(spark, lambda: checks.antonym_collisions(pairs).collect())
    assert sorted((r.pos_a, r.pos_b, r.relation) for r in found) == [(2 * k, 2 * k + 1, "swap") for k in range(40)]
    assert size < 8 * sum(map(len, texts))


def test_antonyms_move_no_words(spark):
    """Words whose opposites the locale has move only if their source has one with the same senses; a caller who wants positions moves no texts."""
    texts = _texts(40, 1500, 4)
    rows = [(2 * k + side, "fr", f"{word} {t}", t) for k, t in enumerate(texts) for side, word in enumerate(("Enable", "Disable"))]
    rows += [(100 + k, "fr", "un" + t.replace(" ", " un"), str(k)) for k, t in enumerate(texts)]
    pairs = spark.createDataFrame(rows, "pos long, locale string, src string, dst string")
    size, found = shuffled(spark, lambda: checks.antonym_collisions(pairs).select("locale", "pos_a", "pos_b", "relation").collect())
    assert sorted((r.pos_a, r.pos_b, r.relation) for r in found) == [(2 * k, 2 * k + 1, "swap") for k in range(40)]
    assert size < sum(map(len, texts))


def test_collapses_leave_texts_behind(spark):
    """Words of sources travel without the translation that they share."""
    texts = _texts(20, 1500, 2)
    rows = [(2 * k + side, "fr", f"{t} {word} here", t) for k, t in enumerate(texts) for side, word in enumerate(("zone", "user"))]
    pairs = spark.createDataFrame(rows, "pos long, locale string, src string, dst string")
    size, found = shuffled(spark, lambda: checks.msgstr_collapses(pairs).collect())
    assert sorted((r.dst, r.n, r.pressed) for r in found) == [(t, 2, False) for t in sorted(texts)]
    assert size < 100 * sum(map(len, texts))


def test_checks_look_at_few_words(spark):
    """Words that no pattern can hold are left out of what most checks read, and the rest is as it was."""
    words = " ".join(_texts(1, 3000, 3))
    row = spark.createDataFrame([(f"{words} NSEC3, rfc 12 - 14 {words} wоrd 1.2.3.4 {words} Zone",)], "t string")
    left = row.select(text.sparse(F.col("t")), text.sparse(F.col("t"), (words.split()[0],))).first()
    assert left[0] == "x NSEC3, x 12 - 14 x wоrd 1.2.3.4 x Zone" and left[1].count(words.split()[0]) >= 3
    pairs = [(1, "ru_RU", "Its 10-12 zones, see ßabout 1.2.3.4", "Её 10 zones, see ßabout 1.2.3.5"), (2, "ru_RU", f"{words} about 5 {words}", f"{words} About 5 {words}"), (3, "fr", f"{words} 25 {words}", f"{words} 2 5 {words}")]
    names = ["numerals", "ipliteral", "englishleak"]
    found = checks.findings(spark.createDataFrame(pairs, "pos long, locale string, src string, dst string"), names).select("pos", "cls").collect()
    assert sorted(map(tuple, found)) == [(1, "englishleak"), (1, "ipliteral"), (1, "numerals"), (2, "englishleak"), (3, "numerals")]


def test_examples_make_findings_once(spark):
    rows = [(k, "fr", f"See %s {'x' * 100}", "Voir") for k in range(9)]
    found = checks.findings(spark.createDataFrame(rows, "pos long, locale string, src string, dst string"), ["placeholder"])
    out = reports.examples(found, ["cls", "locale"], "pos", 2)
    assert "regexp" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.pos, r.place, r.of, len(r.src)) for r in out.orderBy("pos").collect()] == [(0, 1, 9, 88), (1, 2, 9, 88)]


def test_diacritics_tell_few_words_apart(spark):
    """Words without a marked spelling are counted, but not told apart by entry."""
    rows = [(k, "fr", "zone", f"{t} données données données") for k, t in enumerate(_texts(40, 1500, 4))] + [(99, "fr", "zone", "donnees")]
    pairs = spark.createDataFrame(rows, "pos long, locale string, src string, dst string")
    size, _ = shuffled(spark, lambda: diacritics.diacritics(pairs).collect())
    assert size < 4 * sum(len(r[3]) for r in rows)
