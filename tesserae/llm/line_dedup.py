"""Lines that many documents share, with SQL functions only.

Texts are split into lines and the lines' keys hashed to 128 bits. The small table of hashes, not the texts, is dealt by ranges
of the hash and sorted within a range by document and position, so that a window streams over the first occurrences of a key in each document and
counts them. What comes back are the positions to drop, as bitmaps of runs, one for each document that loses a line; texts move once, to meet them.

A key may stand in a third of all lines. A sample of the hashes shows the frequent ones: a key that the sample finds in enough documents is thereby
known to be dropped, exactly, so its lines need not come together and are dealt by document. All other keys are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, written

C = F.col
BLANK = " \t\n\x0b\x0c\r"
#: Lines of the sample for each shuffle partition, and at least in all: a key with a quarter of a partition's lines is in it about 50 times.
SAMPLE_PER_PART, SAMPLE_LEAST = 200, 200_000


def text_of(column: str = "text") -> Column:
    return F.coalesce(C(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, nothing else; for texts of ASCII alone lower() does just that, and faster."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def line_keys(docs: DataFrame, least_chars: int = 1) -> DataFrame:
    """doc_id, tie (hash of the text), pos, h1, h2: a row for each line of docs whose key has `least_chars` code points or more.

    A key is the line without ASCII white space at its ends, A-Z in lower case; h1 and h2 are two independent 64-bit hashes of it.
    """
    text = text_of()
    keys = F.transform(F.split(ascii_lower(text), "\n"), lambda line: F.btrim(line, F.lit(BLANK)))
    lines = docs.select(C("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), F.posexplode(keys).alias("pos", "key")).filter(F.length("key") >= least_chars)
    return lines.select("doc_id", "tie", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))


def _certain(keys: DataFrame, least_docs: int) -> DataFrame:
    """h1, h2 of keys that a sample of the lines finds in least_docs documents: at most sample / least_docs rows, whatever the table's size."""
    wanted, total = max(SAMPLE_LEAST, SAMPLE_PER_PART * parts(keys.sparkSession)), keys.count()
    some = keys.sample(min(1.0, wanted / max(total, 1)), seed=11).select("h1", "h2", "doc_id").distinct()
    return written(some.groupBy("h1", "h2").agg(F.count("*").alias("_n")).filter(C("_n") >= least_docs).select("h1", "h2", F.lit(True).alias("certain")))


def dropped_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """doc_id, tie, pos of the lines whose key stands in `least_docs` documents or more."""
    keys = written(line_keys(docs, least_chars))
    n = parts(docs.sparkSession)
    marked = keys.join(F.broadcast(_certain(keys, least_docs)), ["h1", "h2"], "left")
    dealt = marked.withColumn("salt", F.when(C("certain"), F.pmod(F.xxhash64("doc_id", "tie"), F.lit(n))).otherwise(F.lit(0).cast("long")))
    # ranges of the window's own keys, which are hashes: Catalyst adds no further exchange
    dealt = dealt.repartitionByRange(n, "h1", "h2", "salt")
    group = Window.partitionBy("h1", "h2", "salt")
    before = F.lag(F.struct("doc_id")).over(group.orderBy("doc_id", "tie", "pos"))
    first = dealt.withColumn("first", (before.isNull() | ~before["doc_id"].eqNullSafe(C("doc_id"))).cast("int"))
    counted = first.withColumn("n_docs", F.sum("first").over(group))
    return counted.filter(C("certain") | (C("n_docs") >= least_docs)).select("doc_id", "tie", "pos")


def _runs(at: Column) -> Column:
    """Sorted positions as runs (at, n)."""
    starts = F.filter(at, lambda x, i: (i == 0) | (F.get(at, F.greatest(i - 1, F.lit(0))) != x - 1))
    ends = F.filter(at, lambda x, i: F.coalesce(F.get(at, i + 1) != x + 1, F.lit(True)))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("at"), (b - a + 1).alias("n")))


def keep_bitmaps(docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """doc_id, tie, drop_runs: for each document that loses lines, its keep bitmap in the form of the runs (at, n) of zeros, by position.

    All lines outside of the runs are kept. A run of lines takes 8 bytes whatever its length.
    """
    lost = dropped_lines(docs, least_docs, least_chars).groupBy("doc_id", "tie").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    return lost.select("doc_id", "tie", _runs(C("at")).alias("drop_runs"))


def kept_text(text: Column, runs: Column) -> Column:
    """The text without the lines of the runs; the lines between two runs are copied as a slice, so the work is linear in the text."""
    lines = F.split(text, "\n")

    def between(k: Column) -> Column:
        begin = F.when(k == 0, F.lit(0)).otherwise(F.get(runs, F.greatest(k - 1, F.lit(0)))["at"] + F.get(runs, F.greatest(k - 1, F.lit(0)))["n"])
        return F.slice(lines, begin + 1, F.coalesce(F.get(runs, k)["at"], F.size(lines)) - begin)

    return F.when(runs.isNull(), text).otherwise(F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(runs)), between)), "\n"))


def _met(docs: DataFrame, least_docs: int, least_chars: int) -> DataFrame:
    """The columns of docs as `_held`, `_text`, and drop_runs (null where nothing is dropped)."""
    text = text_of()
    held = docs.select(F.struct(*docs.columns).alias("_held"), text.alias("_text"), C("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_tie"))
    maps = keep_bitmaps(docs, least_docs, least_chars)
    # texts stream past a table of bitmaps, a small part of their size, and are not sorted
    return held.join(maps.hint("shuffle_hash"), C("_id").eqNullSafe(C("doc_id")) & (C("_tie") == C("tie")), "left").select("_held", "_text", "drop_runs")


def without_common_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """docs with the columns they have, their texts without the lines whose key stands in `least_docs` documents or more.

    A null text is one empty line and becomes empty; edge cases are as in line_report().
    """
    met = _met(docs, least_docs, least_chars).withColumn("_kept", kept_text(C("_text"), C("drop_runs")))
    return met.select(*[C("_kept").alias(c) if c == "text" else C("_held")[c].alias(c) for c in docs.columns])


def line_report(docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_lines, n_dropped, kept_sha256, drop_runs.

    A null or empty text is one empty line. Empty keys are never dropped. Documents are told apart by doc_id, null being one: rows that share a doc_id
    count once for a key, but each row, also a repeated one, has its own result. Long lines and texts are read whole; other columns may have any name; an
    empty table gives no rows. If all lines of a text are dropped, an empty text is left.
    """
    met = _met(docs.select("doc_id", "text"), least_docs, least_chars)
    return met.select(
        C("_held.doc_id").alias("doc_id"), F.size(F.split("_text", "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("drop_runs", F.lit(0).cast("long"), lambda a, r: a + r["n"]), F.lit(0).cast("long")).alias("n_dropped"),
        F.sha2(kept_text(C("_text"), C("drop_runs")), 256).alias("kept_sha256"), "drop_runs",
    )
