"""Document fingerprints by winnowing, with SQL functions only.

Grams are runs of `gram` words, hashed by a rolling (cyclic polynomial) hash; in every window of `window` grams the least hash is chosen, the
rightmost among equals, and kept with its position. Two texts that share gram + window - 1 words in a
row share a fingerprint. A text with fewer words than a gram is a gram itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, words

C = F.col


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _turned(x: Column, by: int) -> Column:
    """The 64 bits of x rotated to the left."""
    return F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, 64 - by))


def rolled(h: Column, n: int) -> Column:
    """Cyclic polynomial hashes of all runs of n of h: the values of a hash that rolls along h, one word in and one out at a time.

    Neighbouring runs share their halves: a run of 2 m is one of m, rotated by m, with the next one of m.
    """

    def joined(left: Column, right: Column, size: int, by: int) -> Column:
        """Runs of `size` with the run that follows, `by` words long."""
        return F.transform(F.slice(left, 1, F.greatest(F.size(right) - size, F.lit(0))), lambda x, i: _turned(x, by).bitwiseXOR(F.get(right, i + size)))

    def grow(runs: Column, size: int, digits: str) -> Column:
        if not digits:
            return runs
        double = joined(runs, runs, size, size)
        if digits[0] == "0":
            return _let(double, lambda x: grow(x, 2 * size, digits[1:]))
        return _let(double, lambda x: _let(joined(x, h, 2 * size, 1), lambda y: grow(y, 2 * size + 1, digits[1:])))

    return grow(h, 1, f"{n:b}"[1:])


def grams(text: Column, gram: int = 5) -> Column:
    """Hashes of all grams, in order of their positions; one at least."""

    def of(h: Column) -> Column:
        return F.when(F.size(h) >= gram, F.transform(rolled(h, gram), lambda x: F.xxhash64(x))).otherwise(F.array(F.xxhash64(F.lit(gram), h)))

    return _let(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def winnow(text: Column, gram: int = 5, window: int = 4) -> Column:
    """array<struct<hash: bigint, at: int>> of the chosen grams, by position; a null text is an empty one."""

    def rightmost(g: Column, i: Column) -> Column:
        own = [F.get(g, i + j) for j in range(window)]
        least = F.least(*own)
        out = F.when(own[-1] == least, i + (window - 1))
        for j in range(window - 2, 0, -1):
            out = out.when(own[j] == least, i + j)
        return out.otherwise(i)

    def of(g: Column) -> Column:
        chosen = F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.size(g) - window, F.lit(0))), lambda i: rightmost(g, i)))
        return F.transform(chosen, lambda p: F.struct(F.get(g, p).alias("hash"), p.alias("at")))

    return _let(grams(text, gram), of)


def hashes(fingerprint: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(fingerprint, lambda x: x["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def shown(fingerprint: Column) -> Column:
    """A fingerprint as text: hash:position, hexadecimal and decimal, in order of positions."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(F.hex(x["hash"]), F.lit(":"), x["at"].cast("string"))), " ")


def _ranges(docs: DataFrame, n: int, sample: int = 100) -> Column:
    """Number of the range, of about n, that a row's _key is in; ranges ascend. Their bounds come from about n * sample keys."""
    total = docs.count()
    keys = sorted(r["_key"] for r in docs.select("_key").sample(min(1.0, n * sample / max(total, 1)), seed=3).collect())
    bounds = sorted({keys[len(keys) * k // n] for k in range(1, n)}) if keys else []
    if not bounds:
        return F.lit(0)
    kind = docs.schema["_key"].dataType.simpleString()
    known = F.array(*[F.struct(F.lit(k), F.lit(i).cast("long"), F.lit(t).cast("long")).cast(kind) for k, i, t in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), lambda at, step: at + F.when(F.coalesce(F.get(known, at + step - 1) <= C("_key"), F.lit(False)), step).otherwise(0))


def in_order(docs: DataFrame, per_part: int = 4) -> tuple[DataFrame, Window]:
    """(rows, window): docs (doc_id, text) in whose window, by ascending doc_id, each row is followed by the next one, the last one by the first.

    Texts move once, by ranges of doc_id (and of a hash of the text, so that rows with one doc_id need not meet). The first row of a range is
    also put behind the range before, marked `_extra`. Only range bounds and first keys, as many as ranges, come to the driver.
    """
    text = F.coalesce(C("text").cast("string"), F.lit(""))
    i = C("doc_id").cast("long")
    own = docs.select(i.alias("doc_id"), text.alias("text"), F.struct(i.isNotNull().alias("k"), F.coalesce(i, F.lit(0)).alias("i"), F.xxhash64(text).alias("t")).alias("_key"))
    own = own.withColumn("_range", _ranges(own, per_part * parts(docs.sparkSession)))
    firsts = {r["_range"]: r["first"] for r in own.groupBy("_range").agg(F.min("_key").alias("first")).collect()}
    order = sorted(firsts)
    before = dict(zip(order, [order[-1], *order[:-1]] if order else [], strict=True))
    there = F.struct(C("_range").alias("_range"), F.lit(False).alias("_extra"))
    places = F.array(there)
    if order:
        kind = own.schema["_key"].dataType.simpleString()
        every = range(order[-1] + 1)
        first = F.array(*[F.struct(F.lit(firsts[r]["k"]), F.lit(firsts[r]["i"]).cast("long"), F.lit(firsts[r]["t"]).cast("long")).cast(kind) if r in firsts else F.lit(None).cast(kind) for r in every])
        earlier = F.array(*[F.lit(before.get(r, 0)) for r in every])
        also = F.struct(F.get(earlier, C("_range")).alias("_range"), F.lit(True).alias("_extra"))
        places = F.when(F.coalesce(F.get(first, C("_range")) == C("_key"), F.lit(False)), F.array(there, also)).otherwise(places)
    rows = own.withColumn("_place", F.explode(places)).select("doc_id", "text", "_key", "_place._range", "_place._extra")
    return rows, Window.partitionBy("_range").orderBy("_extra", "_key")


def compared(docs: DataFrame, gram: int = 5, window: int = 4) -> DataFrame:
    """Fingerprints of all docs (doc_id, text), of their edited texts, and likenesses.

    The edited text has the next document's first code points in place of its last quarter; next is by ascending doc_id, null first, then by a
    hash of the text, at the end the first.
    Null texts are empty; a text without words has a fingerprint of one gram, like that of any other such text;
    rows with equal doc_ids are documents of their own; other columns may have any name; an empty table gives no rows.
    """
    rows, follows = in_order(docs)
    drop = F.floor(F.length("text") / 4).cast("int")
    rows = rows.withColumn("_head", F.substring(F.lead("text").over(follows), F.lit(1), drop)).withColumn("_f", winnow(C("text"), gram, window))
    rows = rows.withColumn("_fh", hashes(C("_f"))).withColumn("_next", F.lead("_fh").over(follows)).filter(~C("_extra"))
    rows = rows.withColumn("_edited", F.concat(F.substring("text", F.lit(1), F.length("text") - drop), "_head"))
    rows = rows.select("doc_id", "_f", "_fh", "_next", F.length("text").cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), winnow(C("_edited"), gram, window).alias("_e"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", shown(C("_f")).alias("fingerprint"), shown(C("_e")).alias("edited_fingerprint"),
        likeness(C("_fh"), hashes(C("_e"))).alias("near_edited"), likeness(C("_fh"), C("_next")).alias("near_next"),
    )
