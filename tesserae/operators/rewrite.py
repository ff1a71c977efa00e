"""Rewriting of texts by ordered, guarded rules, and other repairs."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T

C = F.col


@dataclass(frozen=True)
class Rule:
    """Replaces `pattern` by `replacement` in texts of `locale` whose msgid matches include and not exclude, without regard to case."""

    locale: str
    pattern: str
    replacement: str
    include: str | None = None
    exclude: str | None = None


def java_replacement(text: str) -> str:
    r"""A replacement with \1 as one with $1; a dollar sign stays one."""
    return re.sub(r"\\(\d)", r"$\1", text.replace("$", r"\$"))


def applied(text: Column, msgid: Column, locale: Column, rules: list[Rule]) -> Column:
    """The rules one after the other. Echoes of the msgid are left alone."""
    out = text
    for rule in rules:
        guard = locale == rule.locale
        if rule.include:
            guard = guard & msgid.rlike(f"(?i){rule.include}")
        if rule.exclude:
            guard = guard & ~msgid.rlike(f"(?i){rule.exclude}")
        out = F.when(guard, F.regexp_replace(out, rule.pattern, java_replacement(rule.replacement))).otherwise(out)
    return F.when(text == msgid, text).otherwise(out)


def rewritten(rows: DataFrame, rules: list[Rule], src: str = "src", dst: str = "dst", locale: str = "locale") -> DataFrame:
    """rows with new_dst and changed."""
    return rows.withColumn("new_dst", applied(C(dst), C(src), C(locale), rules)).withColumn("changed", ~C("new_dst").eqNullSafe(C(dst)))


def without_leaks(src: Column, dst: Column) -> Column:
    """Letters Z glued to a printf spec go, unless the source has them."""
    pattern = r"(%(?:\d+\$)?[sdfucxXob])Z+"
    return F.when(src.rlike(pattern), dst).otherwise(F.regexp_replace(dst, pattern, "$1"))


def with_trailing_space(src: Column, dst: Column) -> Column:
    """The source's run of white space at the end, where the target lost it."""
    return F.when((T.trail(src) != "") & (T.trail(dst) == ""), F.concat(dst, T.trail(src))).otherwise(dst)


def restored_identifiers(src: Column, dst: Column) -> Column:
    """Identifiers of the source whose separators were mangled in the target, longest first."""
    tokens = F.array_sort(F.array_distinct(T.identifiers(src)), lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))

    def mend(text: Column, token: Column) -> Column:
        loose = F.concat(F.lit("(?i)"), F.regexp_replace(token, r"[._-]", "[\\\\s._-]{1,3}"))
        return F.when(F.contains(text, token), text).otherwise(F.regexp_replace(text, loose, F.regexp_replace(token, r"\$", r"\\\$")))

    return F.when(dst == src, dst).otherwise(F.aggregate(tokens, dst, mend))


def year_rolled(text: Column, year: int) -> Column:
    """The year before `year` at the end of a range in a copyright line as `year`."""
    return F.regexp_replace(text, rf"(?<=Copyright )((?:\d{{4}}-)?){year - 1}(?!\d)", f"$1{year}".replace("$1", "$1\\"))


def blank_lines_trimmed(text: Column) -> Column:
    """Lines of nothing but spaces and tabs as empty lines."""
    return F.regexp_replace(text, r"(?m)^[ \t]+$", "")


def obsolete_kept(entries: DataFrame) -> DataFrame:
    """Obsolete entries with a text turn into comments; those without go."""
    text = F.coalesce(C("msgstr"), F.lit(""))
    kept = entries.filter(~C("obsolete") | (text != ""))
    return kept.withColumn("raw", F.when(C("obsolete"), F.regexp_replace("raw", r"(?m)^#~ ", "# OBSOLETE: ")).otherwise(C("raw")))


def english_fallback(entries: DataFrame, failing: DataFrame, nplurals: Column) -> DataFrame:
    """Failing entries (by pos) get their msgid as text; plural ones msgid and msgid_plural for as many forms as the locale has."""
    bad = failing.select(C("pos").alias("_p")).distinct()
    rows = entries.join(bad, C("pos") == C("_p"), "left")
    fails = C("_p").isNotNull()
    forms = F.map_from_arrays(F.sequence(F.lit(0), nplurals - 1), F.transform(F.sequence(F.lit(0), nplurals - 1), lambda i: F.when((i == 0) & (nplurals > 1), C("msgid")).otherwise(C("msgid_plural"))))
    plural = F.coalesce(C("msgid_plural"), F.lit("")) != ""
    return rows.withColumns({"msgstr": F.when(fails & ~plural, C("msgid")).otherwise(C("msgstr")), "plurals": F.when(fails & plural, forms).otherwise(C("plurals"))}).drop("_p")


def cleared_flags(flags: Column, *names: str) -> Column:
    return F.array_except(flags, T.literal_array(list(names)))


def imported(entries: DataFrame, payload: DataFrame) -> DataFrame:
    """entries with the payload's translation (msgid, translation), which clears `fuzzy`; dirty says what changed."""
    p = payload.filter(F.coalesce(C("translation"), F.lit("")) != "").select(C("msgid").alias("_k"), "translation")
    rows = entries.join(p, C("msgid") == C("_k"), "left")
    hit = C("translation").isNotNull()
    return rows.select(
        *[c for c in entries.columns if c not in ("msgstr", "flags")], F.coalesce("translation", "msgstr").alias("msgstr"),
        F.when(hit, cleared_flags(C("flags"), "fuzzy")).otherwise(C("flags")).alias("flags"),
        (hit & ~C("translation").eqNullSafe(C("msgstr"))).alias("dirty"),
    )


def reviewed(entries: DataFrame, fixes: DataFrame, literals: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(result, problems) of reviewed fixes (msgid, text): all or nothing for each locale.

    A fix whose msgid is unknown, or that the gate refuses, is a problem; a locale with one keeps its entries.
    """
    from .checks import gate_reasons

    e = entries.select(C("locale").alias("_l"), C("msgid").alias("_k"))
    tried = fixes.join(e, (C("locale") == C("_l")) & (C("msgid") == C("_k")), "left")
    reasons = F.when(C("_k").isNull(), F.array(F.lit("unknown"))).otherwise(gate_reasons(C("msgid"), C("text"), C("locale"), literals))
    problems = tried.withColumn("reasons", reasons).filter(F.size("reasons") > 0).select("locale", "msgid", "text", "reasons")
    bad = problems.select("locale").distinct()
    good = fixes.join(bad, "locale", "left_anti").groupBy(C("locale").alias("_l"), C("msgid").alias("_k")).agg(F.max("text").alias("_text"))
    rows = entries.join(good, (C("locale") == C("_l")) & (C("msgid") == C("_k")), "left")
    out = rows.withColumns({"msgstr": F.coalesce("_text", "msgstr"), "flags": F.when(C("_k").isNotNull(), cleared_flags(C("flags"), "fuzzy", "auto-english-fallback")).otherwise(C("flags"))})
    return out.drop("_l", "_k", "_text"), problems
