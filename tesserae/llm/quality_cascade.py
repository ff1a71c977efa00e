"""Quality rules as a short-circuit cascade of SQL expressions.

Each rule names the features it reads. On a bounded sample every feature is timed on its own, and every rule judges every
row: a rule's cost is that of the features that no rule before it has computed, its selectivity the share of the rows left that it
rejects. The rule with the most rejections per cost comes next, and each feature is computed only for rows that no earlier
rule has rejected. The order never changes the verdict, only the work.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words, written

C = F.col
WINDOW = 8


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _windows() -> Column:
    def at(i: Column) -> Column:
        return F.xxhash64(*[F.get(C("word_hashes"), i + j) for j in range(WINDOW)])

    return F.when(C("n_words") >= WINDOW, F.transform(F.sequence(F.lit(0), C("n_words").cast("int") - WINDOW), at)).otherwise(F.array().cast("array<bigint>"))


def _equal_neighbours() -> Column:
    s = C("sorted_windows")
    twice = F.filter(s, lambda x, j: (x["h"] == F.get(s, j + 1)["h"]) | ((j > 0) & (x["h"] == F.get(s, F.greatest(j - 1, F.lit(0)))["h"])))
    return F.array_sort(F.transform(twice, lambda x: x["i"]))


def _covered() -> Column:
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    step = F.aggregate(
        C("window_starts"), start,
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return F.coalesce(step, F.lit(0)).cast("long")


@dataclass(frozen=True)
class Feature:
    needs: tuple[str, ...]
    value: Column


def features(text: str = "text") -> dict[str, Feature]:
    """All features, by name; a null text is empty."""
    t = F.coalesce(C(text).cast("string"), F.lit(""))
    return {
        "words": Feature((), words(C(text).cast("string"))),
        "n_words": Feature(("words",), F.size("words").cast("long")),
        "word_hashes": Feature(("words",), F.transform("words", lambda w: F.xxhash64(w))),
        "word_chars": Feature(("words",), F.length(F.concat_ws("", C("words"))).cast("long")),
        "n_symbols": Feature((), F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long")),
        "n_capitals": Feature((), F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long")),
        "lines": Feature((), _lines(t)),
        "n_lines": Feature(("lines",), F.size("lines").cast("long")),
        "n_dup_lines": Feature(("lines",), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")),
        "windows": Feature(("n_words", "word_hashes"), _windows()),
        # only texts with a repeated window are sorted
        "sorted_windows": Feature(("windows",), F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))),
        "window_starts": Feature(("sorted_windows",), _equal_neighbours()),
        "n_repeat_words": Feature(("window_starts",), _covered()),
        "n_stutters": Feature(("word_hashes",), F.size(F.filter("word_hashes", lambda h, i: (i > 0) & (h == F.get(C("word_hashes"), F.greatest(i - 1, F.lit(0)))))).cast("long")),
    }


@dataclass(frozen=True)
class Rule:
    """Rejects a row where `test` is true; null counts as false."""

    name: str
    needs: tuple[str, ...]
    test: Column


def base_rules() -> list[Rule]:
    return [
        Rule("few_words", ("n_words",), C("n_words") < 20),
        Rule("repeated_words", ("n_words", "n_repeat_words"), 100 * C("n_repeat_words") > 30 * C("n_words")),
    ]


def own_rules() -> list[Rule]:
    """The method's rules. Their bounds lie well beyond those of ordinary prose."""
    return [
        Rule("symbols", ("n_words", "n_symbols"), 10 * C("n_symbols") > C("n_words")),
        Rule("duplicate_lines", ("n_lines", "n_dup_lines"), 100 * C("n_dup_lines") > 40 * C("n_lines")),
        Rule("word_length", ("n_words", "word_chars"), (C("word_chars") < 2 * C("n_words")) | (C("word_chars") > 12 * C("n_words"))),
        Rule("stutter", ("n_words", "n_stutters"), 100 * C("n_stutters") > 25 * C("n_words")),
        Rule("capitals", ("word_chars", "n_capitals"), 100 * C("n_capitals") > 35 * C("word_chars")),
    ]


def _needed(names: tuple[str, ...], known: dict[str, Feature], have: set[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        if name not in have and name not in out:
            out += [x for x in _needed(known[name].needs, known, have) if x not in out]
            out.append(name)
    return out


def _private(name: str) -> str:
    return f"_quality_{name}"


def cascade(docs: DataFrame, rules: list[Rule], always: tuple[str, ...] = (), text: str = "text") -> DataFrame:
    """docs with `rejected_by` (the first rule in the given order to reject a row, else null).

    Features in `always` are computed for every row and returned; others only for rows that
    no earlier rule has rejected, and not returned. Columns of docs named like a feature are
    kept aside, and a feature takes their place only if it is in `always`.
    """
    known = features(text)
    aside = {c: _private(c) for c in docs.columns if c in (*known, "rejected_by") and c != text}
    out = docs.withColumnsRenamed(aside).withColumn("rejected_by", F.lit(None).cast("string"))
    have: set[str] = set()

    def add(names: tuple[str, ...], guarded: bool) -> None:
        nonlocal out
        for name in _needed(names, known, have):
            value = known[name].value
            out = out.withColumn(name, F.when(C("rejected_by").isNull(), value) if guarded else value)
            have.add(name)

    add(always, False)
    for rule in rules:
        add(rule.needs, True)
        out = out.withColumn("rejected_by", F.coalesce(C("rejected_by"), F.when(rule.test, F.lit(rule.name))))
    back = [C(_private(c)).alias(c) if c in aside and c not in always else C(c) for c in docs.columns]
    return out.select(*back, *[c for c in always if c not in docs.columns], "rejected_by")


def feature_costs(sample: DataFrame, names: list[str], text: str = "text", enough: float = 0.15, most: int = 64) -> dict[str, float]:
    """Seconds that each feature takes for `sample`, from the features that it needs, which sample has too.

    For each feature the sample is repeated until a run takes `enough` seconds, at most `most` times, so that what is measured is not the
    start of a job; the time of such a run over the texts alone is subtracted. Runs are in one task.
    """
    known = features(text)
    held = sample.coalesce(1)

    def run(repeats: int, value: Column) -> float:
        began = time.perf_counter()
        rows = held.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
        rows.agg(F.max(F.xxhash64(value))).collect()
        return time.perf_counter() - began

    bases: dict[int, float] = {}
    out = {}
    for name in names:
        repeats = 1
        while (took := run(repeats, known[name].value)) < enough and repeats < most:
            repeats *= 8
        if repeats not in bases:
            run(repeats, C(text))
            bases[repeats] = run(repeats, C(text))
        out[name] = max(min(took, run(repeats, known[name].value)) - bases[repeats], 1e-6) / repeats
    return out


def measured(docs: DataFrame, rules: list[Rule], rows: int = 500, text: str = "text") -> list[tuple[Rule, float, float]]:
    """(rule, cost, share rejected) in the order in which they should run.

    Costs and shares come from a sample of about `rows` rows, taken in parallel; it only orders the rules. The cost is that of the
    features that no rule before has computed, in seconds, the share that of the rows that no rule before has rejected.
    """
    total = docs.count()
    known, every = features(text), []
    for rule in rules:
        every += [x for x in _needed(rule.needs, known, set(every)) if x not in every]
    if not total:
        return [(r, 0.0, 0.0) for r in rules]
    sample = docs.select(C(text)).sample(min(1.0, rows / total), seed=7)
    for name in every:
        sample = sample.withColumn(name, known[name].value)
    sample = written(sample.withColumns({f"_rule_{k}": F.coalesce(r.test, F.lit(False)) for k, r in enumerate(rules)}))
    verdicts = np.array([tuple(r) for r in sample.select(*[f"_rule_{k}" for k in range(len(rules))]).collect()], bool).reshape(-1, len(rules))
    costs = feature_costs(sample, every, text) if len(verdicts) else dict.fromkeys(every, 1.0)
    out, have, left, open_ = [], set(), list(range(len(rules))), np.ones(len(verdicts), bool)
    while left:
        price = {k: sum(costs[f] for f in _needed(rules[k].needs, known, have)) + 1e-7 for k in left}
        share = {k: float(verdicts[open_, k].mean()) if open_.any() else 0.0 for k in left}
        best = max(left, key=lambda k: (share[k] / price[k], -price[k]))
        out.append((rules[best], price[best], share[best]))
        have |= set(_needed(rules[best].needs, known, have))
        open_ &= ~verdicts[:, best]
        left.remove(best)
    return out


def ordered(docs: DataFrame, rules: list[Rule], rows: int = 500, text: str = "text") -> list[Rule]:
    return [rule for rule, _, _ in measured(docs, rules, rows, text)]


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by.

    A null or empty text has no words and fails; repeated rows get a row each; other columns may have any name; an empty table gives none.
    """
    own = docs.select("doc_id", "text")
    always = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = cascade(own, base_rules() + ordered(own, own_rules()), always)
    failed = (C("n_words") < 20) | (100 * C("n_repeat_words") > 30 * C("n_words"))
    return out.select("doc_id", *always, failed.alias("base_failed"), C("rejected_by").isNull().alias("kept"), "rejected_by")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that no rule rejects, with the columns of docs, whatever their names; a null or empty text is rejected, repeated rows stay or go alike, an empty table gives none.

    The filter reads a column that is not deterministic: Catalyst would otherwise push the verdict
    down to the scan and there compute each array anew inside the functions over it.
    """
    held = docs.select("text", F.struct(*docs.columns).alias("_held"))
    judged = cascade(held, ordered(held, base_rules() + own_rules())).withColumn("_number", F.monotonically_increasing_id())
    return judged.filter(C("rejected_by").isNull() & (C("_number") >= 0)).select("_held.*")
