"""Coverage: what is filled, real, an echo, or empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

C = F.col


def is_untranslated(src: Column, dst: Column, locale: Column, home: str = "en_EN") -> Column:
    """Empty, or an echo of the source; in the home locale an echo is a translation."""
    return (F.coalesce(dst, F.lit("")) == "") | ((dst == src) & (locale != home))


def plural_untranslated(msgid: Column, msgid_plural: Column, plurals: Column, with_plural: bool = True) -> Column:
    """Any form empty, or an echo of msgid - and of msgid_plural, in one of the two readings."""
    echo = (lambda v: (v == msgid) | (v == msgid_plural)) if with_plural else (lambda v: v == msgid)
    return F.exists(F.map_values(plurals), lambda v: (v == "") | echo(v)) | (F.size(plurals) == 0)


def is_excluded(text: Column, exclusions: list[str]) -> Column:
    """Technical text that needs no translation: listed, all its words listed, or a short word in capitals."""
    if not exclusions:
        return F.lit(False)
    upper = T.literal_array(sorted({x.upper() for x in exclusions}))
    words = T.white_space_words(text)
    listed = text.isin(*exclusions)
    all_listed = (F.size(words) > 0) & F.forall(words, lambda w: F.array_contains(upper, F.upper(w)))
    capitals = (F.length(text) <= 5) & (F.upper(text) == text) & (F.lower(text) != text)
    return listed | all_listed | capitals


def issue_types(src: Column, dst: Column) -> Column:
    return F.when(F.coalesce(dst, F.lit("")) == "", "empty").when(dst == src, "untranslated")


def coverage(pairs: DataFrame, exclusions: list[str], flagged: Column | None = None, orphaned: Column | None = None) -> DataFrame:
    """Per locale: total, filled, real, fallback, identity, orphaned, pct (null where total is 0). Excluded and orphaned sources are no part of the total.

    flagged: filled from English; an echo that is flagged is a fallback, another one of one or two words an identity, a longer one neither. orphaned: the entry is obsolete.
    """
    flagged = F.lit(False) if flagged is None else F.coalesce(flagged, F.lit(False))
    orphaned = F.lit(False) if orphaned is None else F.coalesce(orphaned, F.lit(False))
    rows = pairs.withColumns({"_flagged": flagged, "_orphaned": orphaned})
    kept = ~C("_orphaned") & ~is_excluded(C("src"), exclusions)
    filled = F.coalesce(C("dst"), F.lit("")) != ""
    echo = filled & is_untranslated(C("src"), C("dst"), C("locale"))
    short = F.size(T.find(C("src"), r"[\p{L}\p{N}_]+")) <= 2
    count = lambda test: F.count_if(kept & test)
    out = rows.groupBy("locale").agg(
        F.count_if(kept).alias("total"), count(filled).alias("filled"), count(filled & ~echo).alias("real"), count(echo & C("_flagged")).alias("fallback"),
        count(echo & ~C("_flagged") & short).alias("identity"), F.count_if(C("_orphaned") & (F.coalesce(C("src"), F.lit("")) != "")).alias("orphaned"),
    )
    return out.withColumn("pct", F.round(F.try_divide(100.0 * C("real"), C("total")), 2))


def reported(per_locale: DataFrame) -> DataFrame:
    """Locales of a report: those with anything to translate, with `done` where 95 % is real."""
    return per_locale.filter(C("total") > 0).withColumn("done", C("pct") >= 95)


def totals(per_locale: DataFrame) -> DataFrame:
    """One row over all locales, with whole averages; zeros without any."""
    return per_locale.agg(
        F.count("*").alias("locales"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("real"), F.lit(0)).alias("real"),
        F.coalesce(F.floor(F.sum("total") / F.count("*")), F.lit(0)).alias("average"), F.count_if(C("pct") >= 95).alias("done"),
    )
