"""Column functions over strings. All are built-in expressions, so plans stay in the JVM."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def find(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def has(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


def literal_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it, also where Catalyst would write it out each time."""
    return F.get(F.transform(F.array(value), body), 0)


def strip(text: Column) -> Column:
    """Without white space of any kind at either end (trim removes only spaces)."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def lead(text: Column) -> Column:
    return F.regexp_extract(text, r"(?U)^(\s*)", 1)


def trail(text: Column) -> Column:
    return F.regexp_extract(text, r"(?U)(\s*)$", 1)


def unescape_po(text: Column, single_pass: bool = False) -> Column:
    """Decodes \\n, \\t, \\", \\\\ in that order, so that an escaped backslash before n decodes as in existing catalogues;
    with single_pass each escape is decoded once, the inverse of escape_po()."""
    if single_pass:
        mark = F.lit("\ue000")
        text = F.replace(text, F.lit("\\\\"), mark)
    out = text
    for escaped, plain in (("\\n", "\n"), ("\\t", "\t"), ('\\"', '"')):
        out = F.replace(out, F.lit(escaped), F.lit(plain))
    return F.replace(out, F.lit("\ue000") if single_pass else F.lit("\\\\"), F.lit("\\"))


def escape_po(text: Column) -> Column:
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def sparse(text: Column, but: tuple[str, ...] = ()) -> Column:
    """Text with each run of ordinary words, other than those that begin with one of `but`, as one x: what is left for patterns that such words can't be part of."""
    return F.regexp_replace(text, P.ordinary_run(but), "x ")


def ends_in_space(text: Column) -> Column:
    """The last character is white space of any kind; nothing else of the text is looked at."""
    return F.right(text, F.lit(1)).rlike(r"(?U)\s")


def without_end_space(text: Column) -> Column:
    return F.when(ends_in_space(text), F.regexp_replace(text, r"(?U)\s+$", "")).otherwise(text)


def placeholders(text: Column, pattern: str = P.PRINTF) -> Column:
    """Sorted printf specs; positions are no part of them."""
    return F.array_sort(F.transform(find(text, pattern), lambda x: F.regexp_replace(x, r"\d+\$", "")))


def has_leak(text: Column) -> Column:
    return has(F.replace(text, F.lit("%%"), F.lit("\u0001\u0001")), P.LEAK)


def tags(text: Column) -> Column:
    return F.array_sort(find(text, P.TAG))


def bracket_tokens(text: Column) -> Column:
    return F.array_sort(find(text, P.TOKEN))


def identifiers(text: Column) -> Column:
    return find(text, P.IDENTIFIER)


def ipv4(text: Column) -> Column:
    return F.array_sort(F.array_distinct(find(text, P.IPV4)))


def format_masks(text: Column) -> Column:
    return F.filter(F.array_distinct(find(text, P.FORMAT_MASK)), lambda m: (F.length(m) >= 6) & m.rlike(r"(.)\1"))


def _digit_tables() -> tuple[str, str]:
    own = [chr(c) for c in range(0x600, 0x1E950) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(own), "".join(str(unicodedata.digit(c)) for c in own)


def ascii_digits(text: Column) -> Column:
    """Digits of all scripts as 0-9."""
    return F.when(text.rlike(r"[\p{Nd}&&[^0-9]]"), F.translate(text, *_digit_tables())).otherwise(text)


def numeric_text(text: Column) -> Column:
    """Text with plain digits, citations in one form, and digits that belong to names blanked."""
    return F.regexp_replace(F.regexp_replace(ascii_digits(text), P.CITATION, "$1 "), P.NUMBER_STRIP, " ")


def without_zeros(number: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(number, "^0+", ""), F.lit("")), F.lit("0"))


def numbers(prepared: Column, least: int = 1) -> Column:
    """Distinct numbers of numeric_text(), digits only, with at least that many digits before zeros are cut."""
    digits = F.transform(find(prepared, P.NUMBER), lambda x: F.regexp_replace(x, r"\D", ""))
    return F.array_distinct(F.transform(F.filter(digits, lambda x: F.length(x) >= least), without_zeros))


def ranges(prepared: Column) -> Column:
    """Distinct pairs a-b as strings."""
    both = F.zip_with(find(prepared, P.RANGE, 1), find(prepared, P.RANGE, 2), lambda a, b: F.concat_ws("-", without_zeros(a), without_zeros(b)))
    return F.array_distinct(both)


def signature(text: Column) -> Column:
    return F.array_except(F.array_distinct(find(text, P.SIGNIFICANT)), literal_array(P.STOPWORDS))


def english_words(text: Column) -> Column:
    return F.transform(find(text, P.ENGLISH_WORD), F.lower)


def stem(word: Column) -> Column:
    plural = (F.length(word) > 3) & word.endswith("s") & ~word.rlike("(?:ss|is|us|as)$")
    return F.when(plural, F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(word)


def msgid_key(text: Column) -> Column:
    """Words without articles, lower-cased and stemmed."""
    kept = F.filter(english_words(text), lambda w: ~w.isin("a", "an", "the"))
    return F.transform(kept, stem)


def white_space_words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def prose_mask(text: Column) -> Column:
    """Placeholders, identifiers, tokens and tags blanked."""
    for pattern in (P.PRINTF, P.IDENTIFIER, P.TOKEN, P.TAG):
        text = F.regexp_replace(text, pattern, " ")
    return text


def is_polar(x: Column, y: Column) -> Column:
    """Two words of opposite sense: a listed pair, or one is the other with a negating prefix."""
    out = F.lit(False)
    for a, b in P.POLAR_PAIRS:
        out = out | ((x == a) & (y == b)) | ((x == b) & (y == a))
    for base, marked in ((x, y), (y, x)):
        fits = (F.length(base) >= 3) & ~base.isin(*P.NOT_POLAR)
        for prefix in P.POLAR_PREFIXES:
            out = out | (fits & (marked == F.concat(F.lit(prefix), base)))
    return out


def same_word(x: Column, y: Column) -> Column:
    """An inflection of one word, or an irregular pair."""
    out = F.lit(False)
    for a, b in P.MORPH_PAIRS:
        out = out | ((x == a) & (y == b)) | ((x == b) & (y == a))
    grown = (x.startswith(y) | y.startswith(x)) & (F.abs(F.length(x) - F.length(y)) <= 3)
    return out | grown


def polarity(a: Column, b: Column) -> Column:
    """'swap', 'extended', 'negation' or null: how two arrays of words oppose each other."""
    na, nb = F.size(a), F.size(b)
    n = F.least(na, nb)
    differing = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (i < n) & (F.get(a, i) != F.get(b, i)))
    # the words are compared once, not for each pair of opposites
    first = let(differing, lambda d: F.struct(F.size(d).alias("k"), F.get(a, F.get(d, 0)).alias("x"), F.get(b, F.get(d, 0)).alias("y")))
    one = let(first, lambda d: (d["k"] == 1) & is_polar(d["x"], d["y"]))
    negations = literal_array(P.ENGLISH_NEGATION)
    long_, short = F.when(na >= nb, a).otherwise(b), F.when(na >= nb, b).otherwise(a)
    plain = [F.filter(x, lambda w: ~F.array_contains(negations, w)) for x in (long_, short)]
    added = F.exists(long_, lambda w: F.array_contains(negations, w) & (F.size(F.filter(long_, lambda v: v == w)) > F.size(F.filter(short, lambda v: v == w))))
    negation = (F.abs(na - nb) >= 1) & (F.abs(na - nb) <= 2) & added & (plain[0] == plain[1])
    return let(one, lambda o: F.when(o & (na == nb) & (n >= 1), "swap").when(o & (na != nb) & (n >= 3), "extended").when(negation, "negation"))


def shared_translation(x: Column, y: Column, relation: Column) -> Column:
    x, y = strip(x), strip(y)
    prefix = (F.least(F.length(x), F.length(y)) >= 15) & (x.startswith(y) | y.startswith(x))
    return (x == y) | ((relation == "extended") & prefix)


def https_url(url: Column) -> Column:
    return F.regexp_replace(strip(url), "(?i)^http://", "https://")


def whois_server(response: Column) -> Column:
    found = F.regexp_extract(response, r"(?mi)^whois:[ \t]*(\S+)", 1)
    return F.when((found != "") & (found != "-") & (F.upper(found) != "NULL"), F.lower(found))


def collapse_repeats(text: Column, least: int = 3) -> Column:
    """A word of at least that many letters that follows itself stands once."""
    return F.regexp_replace(text, rf"(?<![\p{{L}}\p{{N}}_])(\p{{L}}{{{least},}})(?: \1(?![\p{{L}}\p{{N}}_]))+", "$1")


def negation_pattern(markers: str, clitic: bool = False) -> str:
    """A pattern for markers of negation, separated by spaces: `word` as a whole, `word-` at a word's start, `-word` at its end, `-word-` anywhere; all anywhere if clitic."""
    edge = r"[\p{L}\p{N}_]"
    parts = []
    for marker in markers.split():
        word = re.escape(marker.strip("-"))
        before, after = ("" if clitic or marker.startswith("-") else f"(?<!{edge})"), ("" if clitic or marker.endswith("-") else f"(?!{edge})")
        parts.append(f"{before}{word}{after}")
    return "(?iu)(?:" + "|".join(parts) + ")"
