"""Integrity checks of (source, target) pairs: one registry, one pass for all row checks."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions.similarity import near_miss_udf, ratio_udf, xor_upto_udf
from ..sources.shared import kept

C = F.col


@dataclass(frozen=True)
class Check:
    """hard: a finding fails the run. build: (src, dst, locale, and a check's own inputs by name) -> boolean Column. sparse: build has few, the sparse forms of both texts, as an input."""

    name: str
    hard: bool
    build: Callable[..., Column]
    sparse: bool = False


ROW_CHECKS: dict[str, Check] = {}


def check(name: str, hard: bool, sparse: bool = False):
    def add(build):
        ROW_CHECKS[name] = Check(name, hard, build, sparse)
        return build

    return add


def _named(word: str) -> str:
    """A name of fixed length as a whole; what stands before it is looked at last."""
    return rf"(?i){word}(?<![A-Za-z0-9]{word})(?![A-Za-z0-9])"


@check("placeholder", True, sparse=True)
def placeholder(src, dst, locale, few):
    return T.placeholders(few[0]) != T.placeholders(few[1])


@check("leak", True, sparse=True)
def leak(src, dst, locale, few):
    return T.has_leak(few[1]) & ~T.has_leak(few[0])


@check("tags", True)
def tags(src, dst, locale):
    return T.tags(src) != T.tags(dst)


@check("tokens", True, sparse=True)
def tokens(src, dst, locale, few):
    return T.bracket_tokens(few[0]) != T.bracket_tokens(few[1])


@check("identifiers", True, sparse=True)
def identifiers(src, dst, locale, few):
    return F.exists(T.identifiers(few[0]), lambda x: ~F.contains(dst, x))


@check("trailing", True)
def trailing(src, dst, locale):
    return T.ends_in_space(src) & ~T.ends_in_space(dst)


@check("boilerplate", True, sparse=True)
def boilerplate(src, dst, locale, few, phrases: tuple[str, ...] = ()):
    """Chrome of other products in the target alone; phrases are further ones, wherever they stand."""
    any_of = "|".join([P.BOILERPLATE, *map(re.escape, phrases)])
    return (dst.rlike(any_of) & ~src.rlike(any_of)) | (few[1].rlike(P.WIKI_CHROME) & ~few[0].rlike(P.WIKI_CHROME))


def _translated(letters: str, others: str) -> Callable[[Column], Column]:
    return lambda word: F.translate(word, letters, others)


@check("mixedscript", True, sparse=True)
def mixedscript(src, dst, locale, few, phonetic: bool = True):
    """Words of two scripts, or an acronym of the source in letters of another one. phonetic=False leaves phonetic forms out."""
    words = T.find(few[1], r"[\p{L}\p{M}]{2,}")
    mixed = F.exists(words, lambda w: w.rlike(r"\p{IsLatin}") & w.rlike(r"[\p{IsGreek}\p{IsCyrillic}]"))
    tables = [P.HOMOGLYPHS, P.PHONETIC][: 1 + phonetic]

    def rescripted(runs: Column) -> Column:
        wanted = F.filter(T.find(few[0], P.ACRONYM), lambda a: ~F.contains(dst, a))
        own = F.concat(*[F.transform(runs, _translated(*table)) for table in tables])
        return F.when(F.size(runs) > 0, F.coalesce(F.arrays_overlap(own, wanted), F.lit(False))).otherwise(F.lit(False))

    return mixed | T.let(T.find(few[1], P.CAPITAL_RUN), rescripted)


@check("nearmiss", True, sparse=True)
def nearmiss(src, dst, locale, few):
    """A capitalised token of the source misspelt in the target; only pairs that could have one reach Python."""
    own = F.array_distinct(T.find(few[0], P.UPPER_RUN))
    missing = F.filter(own, lambda t: (F.length(t) >= 3) & ~F.contains(dst, t))
    stray = F.filter(F.array_distinct(T.find(few[1], P.UPPER_RUN)), lambda t: ~F.array_contains(own, t) & ~F.contains(src, t))
    possible = (F.size(missing) > 0) & (F.size(stray) > 0)
    return possible & near_miss_udf(F.when(possible, missing), F.when(possible, stray))


@check("literalmask", True)
def literalmask(src, dst, locale):
    return F.exists(T.format_masks(src), lambda m: ~F.contains(dst, m))


@check("protocoldowngrade", True)
def protocoldowngrade(src, dst, locale):
    def lost(name: str, other: str) -> Column:
        return src.rlike(_named(name)) & ~dst.rlike(_named(name)) & dst.rlike(_named(other))

    short = dst.rlike(_named("ip[46]")) & ~src.rlike(_named("ip[46]")) & (src.rlike(_named("ipv4")) | src.rlike(_named("ipv6")))
    return lost("https", "http") | lost("ipv6", "ipv4") | lost("ipv4", "ipv6") | short


@check("ipliteral", True, sparse=True)
def ipliteral(src, dst, locale, few):
    own, other = T.ipv4(few[0]), T.ipv4(few[1])
    head = lambda a: F.substring_index(a, ".", 1)

    def wrecked(x: Column) -> Column:
        differ = (F.size(x["own"]) > 0) & (F.size(x["other"]) > 0) & (x["own"] != x["other"])
        missing = F.filter(x["own"], lambda a: ~F.contains(dst, a))
        stray = F.filter(F.array_distinct(T.find(few[1], P.DOTTED)), lambda t: ~F.contains(src, t))
        return differ | F.coalesce(F.arrays_overlap(F.transform(missing, head), F.transform(stray, head)), F.lit(False))

    six = F.filter(F.array_distinct(T.find(few[0], P.COLONHEX)), lambda t: (F.contains(t, F.lit("::")) | (F.length(t) - F.length(F.replace(t, F.lit(":"))) >= 3)) & ~F.contains(dst, t))
    stray6 = F.filter(F.array_distinct(T.find(few[1], P.COLONHEX)), lambda t: ~F.contains(src, t))
    possible = (F.size(six) > 0) & (F.size(stray6) > 0)
    return T.let(F.struct(own.alias("own"), other.alias("other")), wrecked) | (possible & (ratio_udf(F.when(possible, six), F.when(possible, stray6)) >= 0.6))


@check("fragment_punctuation", True)
def fragment_punctuation(src, dst, locale):
    count = lambda t, c: F.length(t) - F.length(F.replace(t, F.lit(c)))

    def ill_ended(x: Column) -> Column:
        s, d = x["s"], x["d"]
        ended = F.right(d, F.lit(1)).isin("?", ".", "!")
        bracket = d.endswith(")") & (count(s, "(") > count(s, ")"))
        colon = s.endswith(":") & ended
        # only sources that end in a letter before such a target are cut into words
        last = F.lower(F.regexp_replace(F.element_at(T.white_space_words(s), -1), "^[.,;:!?()\\[\\]\"']+|[.,;:!?()\\[\\]\"']+$", ""))
        open_ended = ended & F.right(s, F.lit(1)).rlike(r"[\p{L}\p{N}]") & ((d.endswith("?") & s.rlike(P.QUESTION_OPENER)) | last.isin(*P.FRAGMENT_TAIL))
        return (s != "") & (d != "") & (bracket | colon | F.coalesce(open_ended, F.lit(False)))

    return T.let(F.struct(T.without_end_space(src).alias("s"), T.without_end_space(dst).alias("d")), ill_ended)


@check("escape_artifact", True)
def escape_artifact(src, dst, locale):
    return F.contains(dst, F.lit('\\"')) & ~F.contains(src, F.lit('\\"'))


@check("unlocalized", True)
def unlocalized(src, dst, locale):
    """Two words of prose in the source, and no letter of the locale's script in the target, which is looked at first."""
    prose = F.regexp_replace(F.regexp_replace(src, P.TAG, " "), P.TOKEN, " ")
    word = r"(?<![A-Za-z0-9])(?=[A-Z]*+[a-z])[A-Za-z]{4,}+(?![A-Za-z0-9])"
    out = F.lit(False)
    for name, script in P.SCRIPTS.items():
        out = out | ((locale == name) & ~dst.rlike(f"[{script}]"))
    return out & dst.rlike(r"(?U)\S") & prose.rlike(f"(?s){word}.*?{word}")


def _most_common(words: Column) -> Column:
    """word and n of the most frequent word of an array, of equally frequent ones the first. Runs of the sorted words are counted, so the work grows with the words and not with their square."""
    empty = F.struct(F.lit("").alias("word"), F.lit(0).alias("n"), F.lit(0).alias("at"))
    ordered = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))))

    def step(a: Column, x: Column) -> Column:
        on = a["run"]["word"] == x["word"]
        run = F.struct(x["word"].alias("word"), F.when(on, a["run"]["n"] + 1).otherwise(1).alias("n"), F.when(on, a["run"]["at"]).otherwise(x["at"]).alias("at"))
        better = (run["n"] > a["best"]["n"]) | ((run["n"] == a["best"]["n"]) & (run["at"] < a["best"]["at"]))
        return F.struct(run.alias("run"), F.when(better, run).otherwise(a["best"]).alias("best"))

    return F.aggregate(ordered, F.struct(empty.alias("run"), empty.alias("best")), step, lambda a: a["best"])


@check("repetition", True)
def repetition(src, dst, locale):
    """Of six words or more, the most frequent has at most two letters and fills two fifths, six times at least; of equally frequent words the first counts."""

    def repeated(words: Column) -> Column:
        n = F.size(words)
        short = F.size(F.filter(words, lambda w: F.length(w) <= 2))
        often = T.let(_most_common(words), lambda top: (F.length(top["word"]) <= 2) & (top["n"] >= 6) & (top["n"] >= n * F.lit(0.4)))
        # only texts of that many short words are sorted
        return F.when((short >= 6) & (short >= n * F.lit(0.4)), often).otherwise(F.lit(False))

    return T.let(T.white_space_words(dst), repeated)


@check("numerals", False, sparse=True)
def numerals(src, dst, locale, few):
    """A number of two digits or more, or a range whose ends the target hasn't, is lost; only sources with a digit are prepared."""

    def lost(x: Column) -> Column:
        gone, present = F.array_except(T.ranges(x["s"]), T.ranges(x["d"])), T.numbers(x["d"])
        ends = F.exists(gone, lambda r: F.size(F.array_except(F.split(r, "-"), present)) > 0)
        return (F.size(F.array_except(T.numbers(x["s"], 2), T.numbers(x["d"], 2))) > 0) | ends

    return F.when(src.rlike(r"\p{Nd}"), T.let(F.struct(T.numeric_text(few[0]).alias("s"), T.numeric_text(few[1]).alias("d")), lost)).otherwise(F.lit(False))


@check("truncation", False)
def truncation(src, dst, locale):
    return ~locale.isin(*P.CJK_LOCALES) & (2 * F.length(dst) < F.length(src)) & (F.size(T.white_space_words(src)) >= 8)


@check("rrtype", False, sparse=True)
def rrtype(src, dst, locale, few):
    names = T.literal_array(P.RECORD_TYPES)
    return F.exists(F.array_intersect(F.array_distinct(T.find(few[0], r"[A-Za-z0-9]+")), names), lambda n: ~F.contains(dst, n))


@check("englishleak", False)
def englishleak(src, dst, locale, prose: tuple[str, ...] = tuple(P.PROSE)):
    """A word of ordinary English that the source has too, in a target of another script."""

    def latin(text: Column) -> Column:
        kept = F.filter(T.find(F.regexp_replace(T.sparse(text, prose), P.LEAK_STRIP, " "), P.LATIN_WORD), lambda w: w != F.upper(w))
        return F.array_distinct(F.transform(kept, F.lower))

    leaked = F.array_intersect(latin(dst), T.literal_array(list(prose)))
    # the script is looked at first: most catalogues are in Latin; then the target, as few have such a word
    both = T.let(leaked, lambda x: F.when(F.size(x) > 0, F.coalesce(F.arrays_overlap(x, latin(src)), F.lit(False))).otherwise(F.lit(False)))
    return F.when(locale.isin(*P.SCRIPTS), both).otherwise(F.lit(False))


#: Our own markers of negation by locale or language (fr for fr_FR), as functions.text.negation_pattern reads them; others are given by the caller.
NEGATION = {
    "fr": "ne n' pas aucun aucune jamais sans non rien im- in- -less", "de": "nicht kein- nie niemals ohne nichts un-", "es": "no nunca sin nada ningún ninguna ni in-",
    "ru": "не- нет без- ни- никогда", "el": "δεν μην μη- χωρίς ποτέ", "zh": "不 未 无 非 没",
}
#: Of these, locales that write without spaces or join markers to words.
CLITIC = ("zh", "ja", "ko", "th", "ar", "he", "fa")


@check("negation_loss", False)
def negation_loss(src, dst, locale, markers: dict[str, str] | None = None, clitic: tuple[str, ...] = CLITIC):
    """The source negates and the target has no marker of its language, nor English negation. markers: by locale or, where that has none, by language; a locale without any is not checked."""
    markers = NEGATION if markers is None else markers
    language = F.substring_index(locale, "_", 1)
    lost = F.lit(False)
    for name, words in markers.items():
        own = (locale == name) if "_" in name else ((language == name) & ~locale.isin([x for x in markers if "_" in x] or [""]))
        lost = F.when(own, ~dst.rlike(T.negation_pattern(words, name in clitic or name.split("_")[0] in clitic))).otherwise(lost)
    known = language.isin([x for x in markers if "_" not in x] or [""]) | locale.isin([x for x in markers if "_" in x] or [""])
    # most targets of a negation have one, so the target is looked at first
    return F.when(known & ~dst.rlike(P.ENGLISH_NEGATED) & F.regexp_replace(src, P.ENGLISH_LITERAL, " ").rlike(P.ENGLISH_NEGATED), lost).otherwise(F.lit(False))


def flagged(pairs: DataFrame, names: list[str] | None = None, inputs: dict[str, dict] | None = None) -> DataFrame:
    """pairs (src, dst, locale) with a boolean column for each named row check, all in one projection.

    inputs: a check's own inputs by its name, such as {"englishleak": {"prose": [...]}, "negation_loss": {"markers": {...}}}; the defaults are ours.
    Catalyst computes only the columns that are used, and beside them the sparse forms that some named checks read. A null text is an empty one.
    """
    inputs = inputs or {}
    src, dst, locale = (F.coalesce(C(c), F.lit("")) for c in ("src", "dst", "locale"))
    names = names or list(ROW_CHECKS)
    rows, few = pairs, {}
    if any(ROW_CHECKS[n].sparse for n in names):
        # made once a row for all checks that read them: for a plain column Catalyst would write them out at each use
        rows = pairs.select("*", F.explode_outer(F.array(F.struct(T.sparse(src).alias("src"), T.sparse(dst).alias("dst")))).alias("_few"))
        few = {"few": (C("_few.src"), C("_few.dst"))}
    flags = [F.coalesce(c.build(src, dst, locale, **(few if c.sparse else {}), **inputs.get(c.name, {})), F.lit(False)).alias(f"is_{c.name}") for c in (ROW_CHECKS[n] for n in names)]
    return rows.select("*", *flags).drop("_few")


def findings(pairs: DataFrame, names: list[str] | None = None, inputs: dict[str, dict] | None = None) -> DataFrame:
    """locale, pos, cls, hard, src, dst: a row for each check that a pair fails."""
    names = names or list(ROW_CHECKS)
    classes = F.filter(F.array(*[F.when(C(f"is_{n}"), F.struct(F.lit(n).alias("cls"), F.lit(ROW_CHECKS[n].hard).alias("hard"))) for n in names]), lambda x: x.isNotNull())
    # for a plain explode Catalyst would infer a filter on the array, and so compute every check twice
    rows = flagged(pairs, names, inputs).select("locale", "pos", F.explode_outer(classes).alias("f"), "src", "dst").filter(C("f").isNotNull())
    return rows.select("locale", "pos", "f.cls", "f.hard", "src", "dst")


def finding_counts(found: DataFrame) -> DataFrame:
    """n for each (locale, cls), and with a null locale for each class."""
    return found.rollup("cls", "locale").agg(F.count("*").alias("n")).filter(C("cls").isNotNull())


# --- checks over a whole catalogue -------------------------------------------------------


def _bares(word: Column) -> Column:
    """array<string>: the words that a marked one is the opposite of: the first of its pair, and what stands behind its prefix."""
    out = [F.when(word == b, F.lit(a)) for a, b in P.POLAR_PAIRS]
    for prefix in P.POLAR_PREFIXES:
        base = F.substr(word, F.lit(len(prefix) + 1))
        out.append(F.when(word.startswith(prefix) & (F.length(base) >= 3) & ~base.isin(*P.NOT_POLAR), base))
    return F.array_distinct(F.array_compact(F.array(*out)))


#: All prefixes of a word, as long as three letters stay.
_PREFIXES = rf"^(?:(?:{'|'.join(P.POLAR_PREFIXES)})(?=...))+"


def _prefixed(word: Column) -> Column:
    """A prefix and three letters; without a pattern, as all words of all texts are looked at."""
    return reduce(or_, [word.startswith(prefix) & (F.length(word) >= 3 + len(prefix)) for prefix in P.POLAR_PREFIXES])


def _pair_senses() -> dict[str, str]:
    """What words of pairs are without prefixes, and one word for all of them that pairs connect."""
    out: dict[str, str] = {}
    for pair in P.POLAR_PAIRS:
        x, y = (re.sub(_PREFIXES, "", w) for w in pair)
        old, new = out.setdefault(y, y), out.setdefault(x, x)
        out = {k: new if v == old else v for k, v in out.items()}
    return out


def _senses(words: Column) -> Column:
    """Words such that two of opposite sense are the same word; others may be, too."""
    of_pairs = _pair_senses()
    known = F.create_map(*[F.lit(x) for item in of_pairs.items() for x in item])
    bare = lambda w: T.let(F.regexp_replace(w, _PREFIXES, ""), lambda x: F.coalesce(known[x], x))
    return F.transform(words, lambda w: F.when(_prefixed(w), bare(w)).when(w.isin(*of_pairs), known[w]).otherwise(w))


#: The numbers of words whose senses, from a source's first on, have a hash: sources are compared with longer ones only if they open alike up to the greatest of these.
HEADS = [3, 24, 192]


def antonym_collisions(pairs: DataFrame) -> DataFrame:
    """Sources of opposite sense that share a translation: locale, relation, and for each side t, words, pos and n (t_a, ..., t_b, ...).

    Rows with equal translations t and words are one class of n rows, shown by the least pos; a result is a pair of classes. Only texts that open alike are compared, and
    of these only those that can be opposites: with the same words but for one that is the other's opposite, or with the same words but for negations.

    Pairs are found by hashes of 128 bits. A marked word tells what the other source has in its place, so a source with one gives the hash of its opposite. Texts are read again
    only of sources that have another whose first words have the same senses; they move only if those are many, and a caller who wants no texts moves none for the result.
    """
    # most texts have no white space at their ends, which costs less to see than to take off
    stripped = F.when(F.concat(F.left("dst", F.lit(1)), F.right("dst", F.lit(1))).rlike(r"(?U)\s"), T.strip(C("dst"))).otherwise(C("dst"))
    rows = pairs.filter(C("locale").isNotNull() & C("src").isNotNull() & C("dst").isNotNull())
    words = T.english_words(C("src"))
    read = rows.select("locale", "pos", stripped.alias("t"), "src").select("locale", "pos", F.xxhash64(F.substring("t", 1, 15)).alias("block"), *_digest("t"), F.length("t").alias("long"), words.alias("w"))
    read = read.select("*", F.filter("w", lambda w: ~w.isin(*P.ENGLISH_NEGATION)).alias("p"), _senses(F.slice("w", 1, HEADS[-1])).alias("s"))
    heads = F.array_compact(F.array(*[F.when(F.size("s") >= n, F.xxhash64(F.slice("s", 1, n))) for n in HEADS]))
    texts = ["locale", "block", "t1", "t2", "long"]
    read = read.select("pos", *texts, *_digest("w"), F.size("w").alias("size"), *_digest("p"), F.xxhash64("s").alias("sense"), heads.alias("heads"))
    classes = read.groupBy(*texts, "w1", "w2", "size", "p1", "p2", "sense", "heads").agg(F.min("pos").alias("pos"), F.count("*").alias("n"))
    classes = kept(classes.drop("w1", "w2"))

    # of as many words: those of the same translation whose first words have the same senses; all others stay out
    alike = ["locale", "t1", "t2", "size", "sense"]
    several = classes.groupBy(*alike).agg(F.count("*").alias("k")).filter("k > 1")
    even = classes.join(several, alike, "left_semi").select("pos", *texts, F.lit(True).alias("even"), F.lit(False).alias("short"), F.array().cast("array<int>").alias("ends"))
    # with more words behind: those that open with the senses of a shorter one, as far as heads tell; a key has each of its sizes once, however many rows it has
    opening = ["locale", "block", "head"]
    first = classes.filter(F.size("heads") > 0).withColumn("head", F.get("heads", F.lit(0)))
    varied = first.groupBy(*opening).agg(F.min("size").alias("lo"), F.max("size").alias("hi")).filter("lo < hi")
    grown = kept(first.join(varied, opening, "left_semi").select("pos", *texts, "size", "heads"))
    each = grown.select("pos", *texts, "size", (F.size("heads") - 1).alias("top"), F.posexplode("heads").alias("level", "head"))
    level = [*opening, "level"]
    sizes = each.groupBy(*level).agg(F.collect_set(F.when(C("top") == C("level"), C("size"))).alias("sizes"), F.max("size").alias("hi"))
    sizes = sizes.filter((F.size("sizes") > 0) & (F.array_min("sizes") < C("hi")))
    uneven = each.join(sizes, level).select("pos", *texts, ((C("top") == C("level")) & (C("size") < C("hi"))).alias("short"), F.expr("filter(sizes, n -> n < size)").alias("ends"))
    uneven = uneven.filter(C("short") | (F.size("ends") > 0)).select("pos", *texts, F.lit(False).alias("even"), "short", "ends")
    asked = even.union(uneven).groupBy("pos", *texts).agg(F.max("even").alias("even"), F.max("short").alias("short"), F.flatten(F.collect_list("ends")).alias("ends"))
    asked = kept(asked)

    # of these, the hashes of their words, whole and up to the places asked for, and the same with one marked word turned into its opposite
    again = rows.select("locale", "pos", "src").join(asked, ["locale", "pos"]).select("pos", *texts, "even", "short", "ends", words.alias("w"))
    whole = F.when(C("even") | C("short"), F.array(F.size("w"))).otherwise(F.array().cast("array<int>"))
    again = again.withColumns({"ends": F.array_distinct(F.concat("ends", whole)), "h1": F.transform("w", lambda w, i: _placed(i, w, 1)), "h2": F.transform("w", lambda w, i: _placed(i, w, 2))})
    seconds = [b for _, b in P.POLAR_PAIRS]
    at = F.filter(F.transform("w", lambda w, i: F.when(_prefixed(w) | w.isin(*seconds), F.named_struct(F.lit("i"), i, F.lit("w"), w)).otherwise(F.lit(None))), lambda x: x.isNotNull())
    turned = lambda x, b: F.named_struct(F.lit("i"), x["i"], *[c for k in (1, 2) for c in (F.lit(f"d{k}"), _placed(x["i"], x["w"], k).bitwiseXOR(_placed(x["i"], b, k)))])
    turns = F.flatten(F.transform(at, lambda x: F.transform(_bares(x["w"]), lambda b: turned(x, b))))
    upto = F.arrays_zip(C("ends").alias("n"), xor_upto_udf(C("h1"), C("ends")).alias("x1"), xor_upto_udf(C("h2"), C("ends")).alias("x2"))
    again = again.select("pos", *texts, "even", "short", F.size("w").alias("size"), turns.alias("turns"), F.explode(upto).alias("z")).select("*", "z.*").drop("z")
    full = C("n") == C("size")
    # 0: as many words; 1: the marked one is the shorter; 2: the marked one is the longer
    none = F.struct(F.lit(-1).alias("i"), F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"))
    turns = F.explode(F.concat(F.array(none), F.filter("turns", lambda x: x["i"] < C("n")))).alias("d")
    again = again.select("pos", *texts, "even", "short", "n", full.alias("full"), "x1", "x2", turns).withColumn("marked", C("d.i") >= 0)
    kinds = F.array(F.when(C("full") & C("even"), 0), F.when(F.when(C("marked"), C("full") & C("short")).otherwise(~C("full")), 1), F.when(F.when(C("marked"), ~C("full")).otherwise(C("full") & C("short")), 2))
    again = again.withColumn("kind", F.explode(F.array_compact(kinds)))
    scope = [F.when(C("kind") == 0, C("t1")).otherwise(C("block")), F.when(C("kind") == 0, C("t2")).otherwise(F.lit(0))]
    keys = [F.xxhash64(F.lit(k), "kind", "locale", *scope, "n", C(f"x{k}").bitwiseXOR(C(f"d.d{k}"))).alias(f"k{k}") for k in (1, 2)]
    again = kept(again.select("locale", "pos", "kind", "marked", *keys))
    bare = again.filter(~C("marked")).select("k1", "k2", C("pos").alias("other"))
    opposite = again.filter("marked").join(bare, ["k1", "k2"]).select("locale", "pos", "other", F.when(C("kind") == 0, "swap").otherwise("extended").alias("relation"))

    # the same words but for negations, of which one has one or two more
    plain = ["locale", "t1", "t2", "p1", "p2"]
    unlike = classes.groupBy(*plain).agg(F.min("size").alias("lo"), F.max("size").alias("hi")).filter("lo < hi")
    fewer, more = (classes.join(unlike, plain, "left_semi").select(*plain, C("pos").alias(pos), C("size").alias(f"_{pos}")) for pos in ("pos", "other"))
    negated = fewer.join(more, plain).filter((C("_pos") < C("_other")) & (C("_other") - C("_pos") <= 2)).select("locale", "pos", "other", F.lit("negation").alias("relation"))
    # a pair that is both extended and a negation is extended
    found = opposite.union(negated).groupBy("locale", F.least("pos", "other").alias("pos_a"), F.greatest("pos", "other").alias("pos_b")).agg(F.min("relation").alias("relation"))
    for name in "ab":
        found = found.join(classes.select("locale", *[C(c).alias(f"{c}_{name}") for c in ("pos", "t1", "t2", "long", "n")]), ["locale", f"pos_{name}"])
    found = kept(found)
    same = (C("t1_a") == C("t1_b")) & (C("t2_a") == C("t2_b"))
    # one translation may open with the other, if that is not short; only then translations are read again
    a_longer = C("long_a") > C("long_b")
    opening = found.filter(~same & (C("relation") == "extended") & (C("long_a") != C("long_b")) & (F.least("long_a", "long_b") >= 15))
    opening = kept(opening.withColumns({"longer": F.when(a_longer, C("pos_a")).otherwise(C("pos_b")), **{f"_t{k}": F.when(a_longer, C(f"t{k}_b")).otherwise(C(f"t{k}_a")) for k in (1, 2)}}))
    out = ["locale", "pos_a", "pos_b", "n_a", "n_b", "relation"]
    found = found.filter(same).select(*out)
    if not opening.isEmpty():
        opens = rows.select(C("locale").alias("_l"), C("pos").alias("_p"), "dst").join(opening, (C("_l") == C("locale")) & (C("_p") == C("longer")))
        opens = opens.withColumn("cut", F.substr(stripped, F.lit(1), F.least("long_a", "long_b"))).select("*", *_digest("cut")).filter((C("cut1") == C("_t1")) & (C("cut2") == C("_t2")))
        found = found.union(opens.select(*out))
    for name in "ab":
        shown = pairs.select(C("locale").alias("_l"), C("pos").alias("_p"), T.strip(C("dst")).alias(f"t_{name}"), C("src").alias(f"src_{name}"))
        found = found.join(shown, (C("locale") == C("_l")) & (C(f"pos_{name}") == C("_p"))).drop("_l", "_p")
    return found.select("locale", "pos_a", "pos_b", "t_a", "t_b", "n_a", "n_b", *[T.english_words(C(f"src_{name}")).alias(f"words_{name}") for name in "ab"], "relation")


def length_ratio_medians(pairs: DataFrame) -> DataFrame:
    """locale, ratio: the exact median of dst / src length over sources of 8 characters or more; 1.0 without any."""
    return _ratio_medians(pairs.select("locale", F.length("src").alias("src_size"), F.length("dst").alias("dst_size")))


def _ratio_medians(sizes: DataFrame) -> DataFrame:
    ratio = F.when(C("src_size") >= 8, C("dst_size") / C("src_size"))
    return sizes.groupBy("locale").agg(F.coalesce(F.median(ratio), F.lit(1.0)).alias("ratio"))


def _digest(name: str) -> list[Column]:
    """A column's value as 128 bits, in two columns."""
    return [F.xxhash64(name).alias(f"{name}1"), F.xxhash64(F.lit(1), name).alias(f"{name}2")]


def msgstr_collapses(pairs: DataFrame, share: float = 0.6, substituted: bool = True) -> DataFrame:
    """locale, dst, n: translations that several different sources share and that drop what they say.

    Either the translation is short against all its sources, by the locale's own median ratio, or two
    of the sources differ in one word that is no inflection or synonym. substituted=False leaves the second kind out.
    """
    rows = pairs.filter(C("locale").isNotNull() & C("dst").isNotNull()).select("locale", T.strip(C("dst")).alias("t"), "src", F.length("dst").alias("dst_size")).select("*", *_digest("t"))
    group = ["locale", "t1", "t2"]
    # texts stay behind: translations, and sources that say the same, are hashes of 128 bits
    sizes = kept(rows.select(*group, T.msgid_key(C("src")).alias("k"), F.length("src").alias("src_size"), "dst_size", F.length("t").alias("size")).select(*group, *_digest("k"), "src_size", "dst_size", "size"))
    key = F.struct("k1", "k2")
    groups = sizes.groupBy(*group).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"), F.min("src_size").alias("least"), F.max("size").alias("size"))
    groups = kept(groups.filter((C("n") > 1) & (C("lo") != C("hi"))).drop("lo", "hi"))
    pressed = groups.join(_ratio_medians(sizes), "locale").select(*group, "n", (C("size") < share * C("ratio") * C("least")).alias("pressed"))
    if not substituted:
        out = pressed.filter("pressed")
        shown = rows.join(out, group, "left_semi").groupBy(*group).agg(F.min("t").alias("dst"))
        return out.join(shown, group).select("locale", "dst", "n", "pressed")
    # substitution: only sources of such groups are compared; two of as many words that differ at one place alone agree in all other words' hashes
    own = kept(rows.join(groups, group, "left_semi").select(*group, "t", "src"))
    keys = own.select(*group, T.msgid_key(C("src")).alias("k")).distinct().filter(F.size("k") >= 4)
    whole = keys.withColumns({"size": F.size("k"), "all1": _all_but_none("k", 1), "all2": _all_but_none("k", 2)})  # before the words are unrolled, once a text
    holes = whole.select(*group, "size", "all1", "all2", F.posexplode("k").alias("i", "w"))
    frame = [*group, "size", "i", "h1", "h2"]
    holes = kept(holes.withColumns({f"h{seed}": C(f"all{seed}").bitwiseXOR(_placed(C("i"), C("w"), seed)) for seed in (1, 2)}).select(*frame, "w"))
    ends = holes.groupBy(*frame).agg(F.min("w").alias("x"), F.max("w").alias("y")).filter(C("x") != C("y"))
    differ = lambda x, y: ~T.same_word(x, y) & ~_synonyms(x, y)
    ends = ends.withColumn("met", differ(C("x"), C("y")))
    # of the rest, whose first and last word are alike, all words are looked at
    alike = holes.join(ends.filter(~C("met")), frame, "left_semi").groupBy(*frame).agg(F.sort_array(F.collect_set("w")).alias("ws"))
    alike = alike.filter(F.exists("ws", lambda x: F.exists("ws", lambda y: (x < y) & differ(x, y))))
    met = ends.filter("met").select(*group).union(alike.select(*group)).distinct().withColumn("met", F.lit(True))
    out = pressed.join(met, group, "left").filter(C("pressed") | C("met"))
    shown = own.join(out, group, "left_semi").groupBy(*group).agg(F.min("t").alias("dst"))
    return out.join(shown, group).select("locale", "dst", "n", "pressed")


def _placed(at: Column, word: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), at.cast("long"), word)


def _all_but_none(words: str, seed: int) -> Column:
    """All words of an array with their places as one hash; any one of them can be taken out again."""
    return F.aggregate(F.transform(words, lambda w, i: _placed(i, w, seed)), F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h))


def _synonyms(x: Column, y: Column) -> Column:
    out = F.lit(False)
    for a, b in P.SYNONYM_PAIRS:
        out = out | ((x == a) & (y == b)) | ((x == b) & (y == a))
    return out


def crosswires(pairs: DataFrame, band: int = 80) -> DataFrame:
    """Rows whose target shares nothing with their source's signature but two tokens and half of its own with a neighbour's.

    The band join is an equi-join on token and bucket of positions, each row also in the next bucket.
    """
    rows = pairs.select("locale", "pos", T.signature(C("src")).alias("s"), T.signature(C("dst")).alias("d"))
    lost = rows.filter((F.size("s") >= 2) & (F.size("d") >= 2) & ~F.coalesce(F.arrays_overlap("s", "d"), F.lit(False)))
    bucket = F.floor(C("pos") / band)
    left = lost.select("locale", "pos", F.size("d").alias("size"), "d", F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket")).select("locale", "pos", "size", "bucket", F.explode("d").alias("token"))
    right = rows.select(C("locale").alias("l2"), C("pos").alias("near"), bucket.alias("b2"), F.explode("s").alias("t2"))
    met = left.join(right, (C("locale") == C("l2")) & (C("bucket") == C("b2")) & (C("token") == C("t2")) & (F.abs(C("pos") - C("near")) <= band) & (C("pos") != C("near")))
    shared = met.groupBy("locale", "pos", "size", "near").agg(F.count("*").alias("n"))
    return shared.groupBy("locale", "pos", "size").agg(F.max("n").alias("best")).filter((C("best") >= 2) & (2 * C("best") >= C("size"))).select("locale", "pos", "best")


def term_consistency(pairs: DataFrame, terms: list[tuple[str, str, list[str]]]) -> DataFrame:
    """locale, pos, term: a source with the term whose target has none of the accepted renderings.

    terms: (term, locale, renderings), a small table given by the caller: the plan gets a column for each.
    """
    hits = [F.when((C("locale") == locale) & F.contains(F.lower("src"), F.lit(term)) & ~F.exists(T.literal_array(forms), lambda f: F.contains(C("dst"), f)), F.lit(term)) for term, locale, forms in terms]
    return pairs.select("locale", "pos", F.explode(F.array_compact(F.array(*hits))).alias("term"))


# --- Unicode hygiene ---------------------------------------------------------------------

# Categories of characters that a reader doesn't see. Vertical tab, form feed and file, group and record separators end a line, and so
# aren't seen in one. The zero-width non-joiner belongs to the spelling of some languages.
HIDDEN = {
    "zero_width": r"[\x{200B}\x{200C}\x{200D}\x{2060}\x{FEFF}\x{180E}]", "soft_hyphen": r"\x{00AD}", "bidi_control": r"[\x{202A}-\x{202E}\x{2066}-\x{2069}]",
    "invisible_math": r"[\x{2061}-\x{2064}]", "tag_character": r"[\x{E0000}-\x{E007F}]", "ascii_control": r"[\x00-\x08\x0E-\x1B\x1F\x7F]",
}
NON_JOINER, JOINER_LOCALES = "\u200c", r"^(?:fa|ar|ur|ps)_"
# A character of Latin-1 that is the lead byte of UTF-8, and any that may have been read with it.
MOJIBAKE = r"[\x{00C2}-\x{00C5}][\x{0080}-\x{00FF}]"
_VALID = r"^[\x{00C2}-\x{00C5}][\x{0080}-\x{00BF}]$"


def hidden_in(text: Column, locale: Column) -> Column:
    """array<struct<category, ch>> of the hidden characters of a text."""
    def named(category: str) -> Callable[[Column], Column]:
        return lambda x: F.struct(F.lit(category).alias("category"), x.alias("ch"))

    any_of = "|".join(HIDDEN.values())
    found = F.concat(*[F.transform(T.find(text, p), named(name)) for name, p in HIDDEN.items()])
    # one scan for the texts that have none
    some = F.when(text.rlike(any_of), found).otherwise(F.array().cast("array<struct<category:string,ch:string>>"))
    return F.filter(some, lambda x: (x["ch"] != NON_JOINER) | ~F.coalesce(locale, F.lit("")).rlike(JOINER_LOCALES))


def hidden_characters(pairs: DataFrame) -> DataFrame:
    """locale, category, code, n over the targets; a null target has none."""
    rows = pairs.select("locale", F.explode(hidden_in(C("dst"), C("locale"))).alias("f"))
    return rows.groupBy("locale", C("f.category").alias("category"), F.hex(F.encode("f.ch", "UTF-32")).alias("code")).agg(F.count("*").alias("n"))


def mojibake_in(text: Column) -> Column:
    """Pairs of characters of Latin-1 that are the bytes of one character in UTF-8. Pairs are taken from the left; one that isn't valid UTF-8 was text, and takes its two characters along."""
    return F.filter(T.find(text, MOJIBAKE), lambda x: x.rlike(_VALID))


def mojibake(pairs: DataFrame) -> DataFrame:
    """pattern, n: the damaged pairs of the targets."""
    return pairs.select(F.explode(mojibake_in(C("dst"))).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))


def repaired_mojibake(text: Column) -> Column:
    """Damaged pairs as the character they stand for; all else stays."""
    pieces = T.find(text, f"{MOJIBAKE}|(?s:.)")
    fix = lambda x: F.when(x.rlike(_VALID), F.decode(F.encode(x, "ISO-8859-1"), "UTF-8")).otherwise(x)
    return F.when(F.size(mojibake_in(text)) > 0, F.array_join(F.transform(pieces, fix), "")).otherwise(text)


def translation_artifacts(pairs: DataFrame) -> DataFrame:
    """locale, pos, ch, n: symbols that translations have by accident, and Greek letters in a target that isn't Greek, which the source hasn't."""
    found = T.find(C("dst"), f"{P.ARTIFACTS}|{P.GREEK}")
    rows = pairs.select("locale", "pos", "src", F.explode(found).alias("ch")).filter(~F.contains(C("src"), C("ch")) & ((C("locale") != "el_GR") | ~C("ch").rlike(P.GREEK)))
    return rows.groupBy("locale", "pos", "ch").agg(F.count("*").alias("n"))


def sentinel_leaks(pairs: DataFrame) -> DataFrame:
    """locale, pos of targets that hold a leaked sentinel in any known form while the source doesn't."""
    any_form = "|".join(f"(?:{p})" for p in P.SENTINEL_LEAKS)
    return pairs.filter(C("dst").rlike(any_form) & ~C("src").rlike(any_form)).select("locale", "pos")


# --- the gate before a reviewed change ----------------------------------------------------


def term_pattern(term: str) -> str:
    """A term bounded by other than letters, digits, _, \\, / and -, also with an s behind; without regard to case if it has no capital."""
    fold = "" if any(c.isupper() for c in term) else "(?i)"
    return rf"{fold}(?<![A-Za-z0-9_\\/-]){re.escape(term)}s?(?![A-Za-z0-9_\\/-])"


def term_dropped(src: Column, dst: Column, locale: Column, term: str, exempt: list[str] = ()) -> Column:
    """The source has the term and the target has not, whatever its case and the spaces around slashes; never in an exempt locale."""
    target = F.lower(F.regexp_replace(dst, r"\s*/\s*", "/"))
    return src.rlike(term_pattern(term)) & ~F.contains(target, F.lit(term.lower())) & ~locale.isin(list(exempt) or [""])


def gate_reasons(msgid: Column, new: Column, locale: Column, literals: list[str] | list[tuple[str, list[str]]] = (), old: Column | None = None) -> Column:
    """array<string> of the reasons against a new translation, in order.

    literals: terms that must stay, each alone or with its exempt locales. old: the text that is to be corrected; an echo of the msgid is no translation to correct.
    """
    terms = [(x, []) if isinstance(x, str) else x for x in literals]
    dropped = F.lit(False)
    for term, exempt in terms:
        dropped = dropped | term_dropped(msgid, new, locale, term, exempt)
    reasons = [
        ("placeholders", T.placeholders(msgid, P.GATE_PRINTF) != T.placeholders(new, P.GATE_PRINTF)),
        ("tags", T.tags(msgid) != T.tags(new)),
        ("tokens", T.bracket_tokens(msgid) != T.bracket_tokens(new)),
        ("leading_space", T.lead(msgid) != T.lead(new)),
        ("trailing_space", T.trail(msgid) != T.trail(new)),
        ("identifiers", F.exists(T.identifiers(msgid), lambda x: ~F.contains(new, x))),
        ("addresses", T.ipv4(msgid) != T.ipv4(new)),
        ("literals", dropped),
        ("fallback", F.lit(False) if old is None else F.coalesce(old == msgid, F.lit(False))),
        ("empty", T.strip(new) == ""),
        ("echo", new == msgid),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in reasons]))


def gated(rows: DataFrame, msgid: str = "src", new: str = "dst", locale: str = "locale", literals: list = (), old: str | None = None) -> DataFrame:
    """Rows that the gate refuses, with `reasons` joined by |. The reasons are made once a row: Catalyst would push a filter on them below the projection that makes them."""
    reasons = F.array_join(gate_reasons(C(msgid), C(new), C(locale), literals, C(old) if old else None), "|")
    return rows.select("*", F.explode_outer(F.array(reasons)).alias("reasons")).filter(C("reasons") != "")
