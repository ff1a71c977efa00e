"""How filters share their work: for each part of a corpus, in every order, and as Shapley values.

Each document becomes a mask of the filters that it fails. The counts of the masks make a polynomial in one variable for each filter,
linear in each: where all variables are 0 or 1 it is the number of documents that the filters with 1 remove together, in between its expectation
if each filter is applied with that probability. The Shapley value of a filter is the integral of the polynomial's derivative by its
variable along the diagonal. All of this is exact arithmetic on at most 32 counts for each part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, written

C = F.col
FILTERS = "ABCDE"
BLANK = " \t\n\x0b\x0c\r"
REPORT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


@dataclass(frozen=True)
class Multilinear:
    """Sum of coefficient * product of the variables in a set, over sets of variables given as bits."""

    coefficients: dict[int, int]

    @classmethod
    def removal(cls, counts: dict[int, int]) -> Multilinear:
        """Documents removed: counts[mask] * (1 - product of (1 - q) over the filters of the mask), summed and multiplied out."""
        out: dict[int, int] = {}
        for mask, n in counts.items():
            part = mask
            while part:
                out[part] = out.get(part, 0) + (n if part.bit_count() % 2 else -n)
                part = (part - 1) & mask
        return cls(out)

    def corner(self, ones: int) -> int:
        """Value where the variables of `ones` are 1 and the others 0."""
        return sum(c for part, c in self.coefficients.items() if part & ones == part)

    def diagonal_derivative(self, variable: int) -> Fraction:
        """Integral from 0 to 1 of the derivative by a variable (its bit) where all variables are equal."""
        return sum((Fraction(c, part.bit_count()) for part, c in self.coefficients.items() if part & variable), Fraction(0))


def audited(part: str, rows: list[tuple[int, int, int, int]], filters: str = FILTERS) -> Iterator[tuple]:
    """The report's rows of one part from its (mask, documents, good, toxic), the masks' bits in the order of `filters`."""
    removed, good, toxic = (Multilinear.removal({r[0]: r[k] for r in rows}) for k in (1, 2, 3))
    total, everything, orders = sum(r[1] for r in rows), (1 << len(filters)) - 1, factorial(len(filters))
    bit = {name: 1 << k for k, name in enumerate(filters)}
    alone = {f: removed.corner(everything) - removed.corner(everything & ~b) for f, b in bit.items()}
    shares = {f: removed.diagonal_derivative(b) * orders for f, b in bit.items()}
    for order in permutations(filters):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | bit[f]
            here = removed.corner(after) - removed.corner(before)
            yield (
                part, "".join(order), step, total - removed.corner(after), here, removed.corner(bit[f]) - here, alone[f],
                good.corner(after) - good.corner(before), toxic.corner(after) - toxic.corner(before), int(shares[f]),
            )
            before = after


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest (of the text), mask (bits of A to D that the text fails) for each row of docs (doc_id, text, lang)."""
    text = F.coalesce(C("text").cast("string"), F.lit(""))
    own = docs.select(C("doc_id").cast("long").alias("doc_id"), F.coalesce(C("lang").cast("string"), F.lit("")).alias("part"), text.alias("_t"), F.btrim(text, F.lit(BLANK)).alias("_inner"))
    own = own.withColumn("_w", F.when(C("_inner") == "", F.array().cast("array<string>")).otherwise(F.split("_inner", SPACE)))
    own = own.withColumn("_n", F.size("_w"))
    fails = [
        C("_n") < 100, 100 * F.size(F.array_distinct("_w")) < 80 * C("_n"),
        100 * F.regexp_count("_t", F.lit("[A-Z]")).cast("long") > 10 * F.length("_t").cast("long"), C("_t").rlike("[#$%&*|]"),
    ]
    mask = sum((F.when(test, 1 << k).otherwise(0) for k, test in enumerate(fails)), F.lit(0))
    return own.select("doc_id", "part", F.unhex(F.sha2("_t", 256)).alias("digest"), mask.alias("mask"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic, with bit 4 (E) for texts that a smaller doc_id has too.

    All texts but the firsts of their kind fail E: the firsts are met by digest and doc_id at once, so no group of copies comes together.
    """
    known = labels.filter(C("doc_id").isNotNull()).groupBy(C("doc_id").cast("long").alias("_id")).agg(
        F.max((C("quality") == 1).cast("long")).alias("good"), F.max((C("toxic") == 1).cast("long")).alias("toxic"))
    rows = judged(docs).join(known, C("doc_id") == C("_id"), "left").drop("_id").fillna(0, ["good", "toxic"])
    rows = written(rows)
    sums = [F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least")).select(C("digest").alias("_d"), "least")
    firsts = rows.join(least, (C("digest") == C("_d")) & (C("doc_id") == C("least"))).groupBy("part", "mask").agg(*sums)
    firsts = firsts.unionByName(rows.filter(C("doc_id").isNull()).groupBy("part", "mask").agg(*sums))
    every = rows.groupBy("part", "mask").agg(*sums)
    passed = firsts.select("part", "mask", *[C(c) for c in ("n", "good", "toxic")])
    failed = every.unionByName(firsts.select("part", "mask", *[(-C(c)).alias(c) for c in ("n", "good", "toxic")])).withColumn("mask", C("mask") + 16)
    return passed.unionByName(failed).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part (lang), order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    docs has doc_id, text, lang; labels has doc_id, quality, toxic. A null text is empty, a null lang is the part "". Rows that share a doc_id are documents of their own,
    none of them smaller than the other; a null doc_id neither has nor is a smaller one. Of several labels of a document each of quality 1 and
    toxic 1 counts once; documents without a label are neither good nor toxic. Long texts are read whole, other columns may have any name; an empty table
    gives no rows.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(audited(key[0], list(rows[["mask", "n", "good", "toxic"]].astype("int64").itertuples(index=False, name=None))), columns=[x.split()[0] for x in REPORT.split(", ")])

    return mask_counts(docs, labels).groupBy("part").applyInPandas(run, REPORT)  # at most 32 rows a part
