"""Functions that have no built-in form: Ratcliff-Obershelp similarity, sentinels, punycode. Arrow batches, never row by row through the JVM."""

from __future__ import annotations

import difflib
import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from . import patterns as P


def ratio(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """The greatest similarity between a string of one array and one of the other; 0 for nulls."""
    best = [max((ratio(x, y) for x in xs for y in ys), default=0.0) if xs is not None and ys is not None else 0.0 for xs, ys in zip(a, b, strict=True)]
    return pd.Series(best, dtype="float64")


@F.pandas_udf(ArrayType(LongType()))
def xor_upto_udf(hashes: pd.Series, ends: pd.Series) -> pd.Series:
    """For each of some sizes, the first so many numbers of an array as one."""
    return pd.Series([np.concatenate(([0], np.bitwise_xor.accumulate(np.asarray(h, "int64")))).astype("int64")[np.asarray(e, "int64")] for h, e in zip(hashes, ends, strict=True)], dtype=object)


@dataclass(frozen=True)
class Likeness:
    """How a token of the target compares with a missing one of the source."""

    ratio: float  # Ratcliff-Obershelp
    letters: float  # share of the source token's different letters that the other has
    apart: int  # difference of lengths
    rest: float  # length of the other, as a share
    anagram: bool
    hollow: bool  # the other is the token without some letters inside, its first two and its end's order kept

    @classmethod
    def of(cls, token: str, other: str) -> Likeness:
        left = iter(token)
        inside = len(other) < len(token) and all(c in left for c in other) and not token.startswith(other)
        return cls(
            ratio(token, other), len({*token} & {*other}) / len({*token}), abs(len(token) - len(other)), len(other) / len(token),
            Counter(token) == Counter(other), inside and len(other) >= 3 and other[:2] == token[:2],
        )


# What makes a technical token a near miss (least ratio, least share of letters, greatest difference of lengths), either of
# these; and the least length of a word in capitals for stress that lost letters.
TECHNICAL = [(0.7, 0.0, math.inf), (0.5, 0.75, 2)]
STRESSED_REST = 0.7


def near_miss(token: str, other: str) -> bool:
    """other looks like token with a slip. Words in capitals for stress count only when letters inside are missing."""
    like = Likeness.of(token, other)
    if token in P.ORDINARY_CAPS:
        return like.hollow and like.rest >= STRESSED_REST
    return not like.anagram and any(like.ratio >= least and like.letters >= share and like.apart <= most for least, share, most in TECHNICAL)


@F.pandas_udf(BooleanType())
def near_miss_udf(tokens: pd.Series, others: pd.Series) -> pd.Series:
    found = [ts is not None and os is not None and any(near_miss(t, o) for t in ts for o in os) for ts, os in zip(tokens, others, strict=True)]
    return pd.Series(found, dtype="bool")


_TOKENS = re.compile(rf"</?(?:{P.TAG_NAMES})\b[^<>]*>|{P.MASK_TOKEN}", re.IGNORECASE)


def mask(text: str) -> tuple[str, list[str]]:
    """Text with every placeholder and tag as a numbered sentinel, in order of position, and what they stand for."""
    found: list[str] = []

    def put(match: re.Match) -> str:
        found.append(match.group())
        return f"ZX{len(found) - 1}XZ"

    return _TOKENS.sub(put, text), found


_LEAKS = [re.compile(r"[zZ]\s*[xX]\s*(\d+)\s*[xX]\s*[zZ]"), *map(re.compile, P.SENTINEL_LEAKS)]


def unmask(text: str, found: list[str]) -> str:
    """Sentinels, also with spaces or letters of another case, and their known leaked forms, as what they stand for; unknown numbers stay.

    Forms are tried in order over the whole text; without tokens nothing changes.
    """

    def put(match: re.Match) -> str:
        return found[int(match.group(1))] if int(match.group(1)) < len(found) else match.group()

    if found:
        for form in _LEAKS:
            text = form.sub(put, text)
    return text


@F.pandas_udf(StringType())
def masked_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else mask(t)[0])


@F.pandas_udf(StringType())
def repaired_udf(source: pd.Series, target: pd.Series) -> pd.Series:
    """Targets with leaked sentinels replaced by the tokens of their sources."""
    return pd.Series([None if t is None else unmask(t, mask(s or "")[1]) for s, t in zip(source, target, strict=True)], dtype="object")


# Letters whose mark becomes a letter where marks can't be written.
SPELT_OUT = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "å": "aa", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue", "Å": "Aa"})


def deaccented(text: str) -> str:
    """All combining marks gone, case folded; exact for every script."""
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).casefold()


@F.pandas_udf(StringType())
def deaccented_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else deaccented(t))


@F.pandas_udf(StructType([StructField(c, StringType()) for c in ("folded", "plain", "spelt")]))
def word_forms_udf(word: pd.Series) -> pd.DataFrame:
    """A word with its case folded, then also without its marks, or with its marks spelt out."""
    return pd.DataFrame({"folded": word.map(str.casefold), "plain": word.map(deaccented), "spelt": word.map(lambda w: w.translate(SPELT_OUT).casefold())})


@F.pandas_udf(StringType())
def display_domain_udf(name: pd.Series) -> pd.Series:
    """Punycode labels in their own script; what can't be decoded stays."""

    def show(n: str | None) -> str | None:
        try:
            return n if n is None else n.encode("ascii").decode("idna")
        except UnicodeError:
            return n

    return name.map(show)
