"""A query for each check of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import checks
from ..operators import diacritics as lost_marks
from .pairs import MARKED_SOURCE, PAIR_DAMAGED, PAIR_DOC, PAIR_MARKS, PAIR_OPPOSITES, PAIR_PAGE, PAIR_REPEATS, pair_damaged, pair_doc, pair_marks, pair_opposites, pair_page, pair_repeats, quoted

C = F.col
QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# --- SQL forms of patterns: no lookaround, so boundaries are consumed and spaces stand twice ---
ANY = r"[^\p{L}\p{N}_]"
ASCII = "[^A-Za-z0-9]"


def find(t: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({t}, {quoted(pattern)}, {group})"


def bounded(t: str, pattern: str, outside: str, after: str | None = None) -> str:
    return find(f"replace({t}, ' ', '  ')", f"(?:^|{outside})({pattern})(?:{after or outside}|$)", 1)


def matches(t: str, pattern: str) -> str:
    return f"regexp_matches({t}, {quoted(pattern)})"


def lists_differ(f) -> str:
    return f"list_sort({f('src')}) <> list_sort({f('dst')})"


def lost(items: str) -> str:
    return f"len(list_filter({items}, lambda x: NOT contains(dst, x))) > 0"


def words(t: str, pattern: str) -> str:
    """Runs of ASCII letters and digits that match a pattern as wholes."""
    return f"list_filter({find(t, '[A-Za-z0-9]+')}, lambda x: regexp_full_match(x, {quoted(pattern)}))"


PRINTF = r"%(?:[0-9]+\$)?[-+#0]*[0-9]*(?:\.[0-9]+)?[sdfucxXobeEgG]|%%"
LEAK = r"%(?:[0-9]+\$)?[-+#0]*[0-9]*(?:\.[0-9]+)?[sdfucxXobeEgG][A-Za-z]"
IDENT = r"[a-z][a-z0-9]*(?:_[a-z0-9]+)+|(?:dns|api|misc|db|ldap|mail|pdns)\.[a-z_.]+|[\p{L}\p{N}_-]+\.(?:php|html|twig|js|css|sql|dat|json|ya?ml|conf|ini)"
IP = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?:/[0-9]{1,2})?"
DOTTED = r"[0-9]{1,3}(?:\.[0-9]{1,3}){1,3}(?:/[0-9]{1,3})?"
IP_END = r"[^0-9A-Za-z.]|\.[^0-9A-Za-z]|\.$"


def ips(t: str, pattern: str = IP) -> str:
    return f"list_distinct({bounded(t, pattern, '[^0-9A-Za-z.]', IP_END)})"


def name_in(t: str, name: str) -> str:
    return matches(t, f"(?i)(?:^|{ASCII}){name}(?:{ASCII}|$)")


def downgraded(name: str, other: str) -> str:
    return f"({name_in('src', name)} AND NOT {name_in('dst', name)} AND {name_in('dst', other)})"


S, D = (f"regexp_replace({t}, '\\s+$', '')" for t in ("src", "dst"))
LAST = f"lower(regexp_replace(list_last(list_filter(regexp_split_to_array({S}, '\\s+'), lambda x: x <> '')), {quoted('^[.,;:!?()' + chr(92) + '[' + chr(92) + ']' + chr(34) + chr(39) + ']+|[.,;:!?()' + chr(92) + '[' + chr(92) + ']' + chr(34) + chr(39) + ']+$')}, '', 'g'))"
TAIL_WORDS = "(" + ", ".join(map(quoted, P.FRAGMENT_TAIL)) + ")"


def _count(t: str, c: str) -> str:
    return f"(length({t}) - length(replace({t}, '{c}', '')))"


FRAGMENT = f"""({S} <> '' AND {D} <> '' AND (({_count(S, '(')} > {_count(S, ')')} AND suffix({D}, ')'))
 OR (suffix({S}, ':') AND {matches(D, '[?.!]$')})
 OR ({matches(S, r'[\p{L}\p{N}]$')} AND (({LAST} IN {TAIL_WORDS} AND {matches(D, '[?.!]$')}) OR ({matches(S, r'(?i)^(?:are|is|do|does|did|can|could|will|would|should|have|has)(?:[^\p{L}\p{N}_]|$)')} AND suffix({D}, '?'))))))"""

ACRONYMS = f"list_filter({words('src', '[A-Z][A-Z0-9]{2,}')}, lambda x: NOT contains(dst, x))"
RUNS = find("dst", P.CAPITAL_RUN)
MIXED = f"""(len(list_filter({find('dst', r'[\p{L}\p{M}]{2,}')}, lambda x: regexp_matches(x, '\\p{{Latin}}') AND regexp_matches(x, '[\\p{{Greek}}\\p{{Cyrillic}}]'))) > 0
 OR list_has_any(list_transform({RUNS}, lambda x: translate(x, '{P.HOMOGLYPHS[0]}', '{P.HOMOGLYPHS[1]}')), {ACRONYMS})
 OR list_has_any(list_transform({RUNS}, lambda x: translate(x, '{P.PHONETIC[0]}', '{P.PHONETIC[1]}')), {ACRONYMS}))"""

SCRIPT_SQL = {"ru_RU": "Cyrillic", "zh_CN": "Han", "el_GR": "Greek", "fa_IR": "Arabic"}
NO_SCRIPT = " OR ".join(f"(locale = '{k}' AND NOT regexp_matches(dst, '\\p{{{v}}}'))" for k, v in SCRIPT_SQL.items())
PROSE = f"regexp_replace(regexp_replace(src, {quoted(P.TAG)}, ' ', 'g'), {quoted(P.TOKEN)}, ' ', 'g')"
PROSE_WORDS = f"list_filter({words(PROSE, '[A-Za-z]{4,}')}, lambda x: NOT regexp_matches(x, '^(?:[A-Z0-9]{{2,}})$'))"
WORDS_OF = "list_filter(regexp_split_to_array({t}, '\\s+'), lambda x: x <> '')"


#: English negation and its literals, and markers of the pairs' own languages, written without lookaround.
_NOT = r"(?i)(?:^|[^A-Za-z'])(?:not|no|cannot|can't|never|nor|neither|nothing|without|won't|don't|doesn't|isn't|aren't|didn't|shouldn't|couldn't|wouldn't|hasn't|haven't|wasn't|weren't)(?:[^A-Za-z']|$)"
_LITERAL = "\"[^\"]*\"|'[^']*'|[\u201c\u201d][^\u201c\u201d]*[\u201c\u201d]" r"|[\p{L}\p{N}_]+=[\p{L}\p{N}_]+|[a-zA-Z][a-zA-Z0-9]*(?:[_-][a-zA-Z0-9]+)+"
_MARKERS = {
    "fr": rf"(?i)(?:^|{ANY})(?:(?:ne|n'|pas|aucun|aucune|jamais|sans|non|rien)(?:{ANY}|$)|im|in)|less(?:{ANY}|$)", "de": rf"(?i)(?:^|{ANY})(?:(?:nicht|nie|niemals|ohne|nichts)(?:{ANY}|$)|kein|un)",
    "es": rf"(?i)(?:^|{ANY})(?:(?:no|nunca|sin|nada|ningún|ninguna|ni)(?:{ANY}|$)|in)", "ru": rf"(?i)(?:^|{ANY})(?:(?:нет|никогда)(?:{ANY}|$)|не|без|ни)",
    "el": rf"(?i)(?:^|{ANY})(?:(?:δεν|μην|χωρίς|ποτέ)(?:{ANY}|$)|μη)", "zh": "不|未|无|非|没",
}
_LOST = " OR ".join(f"(split_part(locale, '_', 1) = '{k}' AND NOT {matches('dst', p)})" for k, p in _MARKERS.items())
NEGATION_LOSS = f"({matches(f'regexp_replace(src, {quoted(_LITERAL)}, {quoted(chr(32))}, {quoted(chr(103))})', _NOT)} AND NOT {matches('dst', _NOT)} AND ({_LOST}))"


def _leaked(t: str) -> str:
    stripped = f"regexp_replace({t}, {quoted(P.LEAK_STRIP)}, ' ', 'g')"
    return f"list_distinct(list_transform(list_filter({words(stripped, '[A-Za-z]{4,}')}, lambda x: x <> upper(x)), lambda x: lower(x)))"


_PROSE = "['" + "', '".join("about addresses authentication before cannot changed checked configuration configure credentials dashboard disable disabled display download edit editing emails enable enabled enter existing expected guidelines information invalid layer login logins logout logs management misses missing must options password permission permissions please preview properties queried recovery rejected review security selected selection session settings unknown updated username users zones".split()) + "']"
ENGLISH_LEAK = f"(locale IN ('ru_RU', 'zh_CN', 'el_GR', 'fa_IR') AND list_has_any(list_intersect({_leaked('dst')}, {_PROSE}), {_leaked('src')}))"

ROW_SQL = {
    "placeholder": lists_differ(lambda t: f"list_transform({find(t, PRINTF)}, lambda x: regexp_replace(x, '[0-9]+\\$', ''))"),
    "leak": f"({matches('replace(dst, ' + quoted('%%') + ', chr(1) || chr(1))', LEAK)} AND NOT {matches('replace(src, ' + quoted('%%') + ', chr(1) || chr(1))', LEAK)})",
    "tags": lists_differ(lambda t: find(t, P.TAG)),
    "tokens": lists_differ(lambda t: find(t, P.TOKEN)),
    "identifiers": lost(bounded("src", IDENT, ANY)),
    "trailing": r"(regexp_matches(src, '\s$') AND NOT regexp_matches(dst, '\s$'))",
    "boilerplate": " OR ".join(f"({matches('dst', p)} AND NOT {matches('src', p)})" for p in (rf"(?i)(?:^|{ANY})(?:tweet|tweets|retweet|twitter|facebook|instagram|wikipedia|accessdate|hashtag|opensubtitles|addic7ed|yify|synced by|ripped by)(?:{ANY}|$)", P.WIKI_CHROME)),
    "mixedscript": MIXED,
    "literalmask": lost(f"list_filter({bounded('src', '[YMDHmSxn]{2,}(?:[:-][YMDHmSxn]{2,})*', ASCII)}, lambda x: length(x) >= 6 AND regexp_matches(x, 'YY|MM|DD|HH|mm|SS|xx|nn'))"),
    "protocoldowngrade": "(" + " OR ".join([downgraded("https", "http"), downgraded("ipv6", "ipv4"), downgraded("ipv4", "ipv6"), f"({name_in('dst', 'ip[46]')} AND NOT {name_in('src', 'ip[46]')} AND ({name_in('src', 'ipv4')} OR {name_in('src', 'ipv6')}))"]) + ")",
    "ipliteral": f"""((len({ips('src')}) > 0 AND len({ips('dst')}) > 0 AND list_sort({ips('src')}) <> list_sort({ips('dst')}))
 OR list_has_any(list_transform(list_filter({ips('src')}, lambda x: NOT contains(dst, x)), lambda x: split_part(x, '.', 1)), list_transform(list_filter({ips('dst', DOTTED)}, lambda x: NOT contains(src, x)), lambda x: split_part(x, '.', 1))))""",
    "fragment_punctuation": FRAGMENT,
    "escape_artifact": r"""(contains(dst, '\"') AND NOT contains(src, '\"'))""",
    "unlocalized": f"(trim(dst) <> '' AND len({PROSE_WORDS}) >= 2 AND ({NO_SCRIPT}))",
    "truncation": f"(locale NOT IN ('zh_CN', 'zh_TW', 'ja_JP', 'ko_KR') AND len({WORDS_OF.format(t='src')}) >= 8 AND 2 * length(dst) < length(src))",
    "rrtype": f"len(list_filter(list_intersect({find('src', '[A-Za-z0-9]+')}, [{', '.join(map(quoted, P.RECORD_TYPES))}]), lambda x: NOT contains(dst, x))) > 0",
    "negation_loss": NEGATION_LOSS, "englishleak": ENGLISH_LEAK,
    "repetition": f"(SELECT len(x) >= 6 AND length(w) <= 2 AND c >= 6 AND c >= 0.4 * len(x) FROM (SELECT w, count(*) AS c, min(i) AS f, first(x) AS x FROM (SELECT unnest(x) AS w, generate_subscripts(x, 1) AS i, x FROM (SELECT {WORDS_OF.format(t='dst')} AS x)) GROUP BY w ORDER BY c DESC, f LIMIT 1))",
}
#: These read neighbouring documents, where texts differ as a whole; the others read damaged copies.
ON_NEIGHBOURS = {"truncation", "fragment_punctuation"}
#: This one reads texts of repeated short words.
ON_REPEATS = {"repetition"}


def _row_query(name: str):
    source = pair_doc if name in ON_NEIGHBOURS else pair_repeats if name in ON_REPEATS else pair_damaged

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return checks.flagged(source(spark, sf_dir), [name]).filter(C(f"is_{name}")).select("pos", "locale")

    return query


for _name in checks.ROW_CHECKS:
    QUERIES[f"chk_{_name}"] = _row_query(_name)
    if _name in ROW_SQL:
        ORACLES[f"chk_{_name}"] = f"WITH {PAIR_DOC if _name in ON_NEIGHBOURS else PAIR_REPEATS if _name in ON_REPEATS else PAIR_DAMAGED} SELECT pos, locale FROM pair WHERE {ROW_SQL[_name]}"

COUNTED = [n for n in checks.ROW_CHECKS if n in ROW_SQL and n not in ON_NEIGHBOURS]


def _counts(names: list[str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return checks.finding_counts(checks.findings(pair_damaged(spark, sf_dir), names)).select("cls", "locale", C("n").cast("long").alias("n"))

    return query


def _totals(names: list[str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = checks.findings(pair_damaged(spark, sf_dir), names)
        return found.groupBy("hard").agg(F.count("*").alias("n"), F.count_distinct("pos").alias("rows"), F.count_distinct("cls").alias("classes"))

    return query


_ALL = " UNION ALL ".join(f"SELECT pos, locale, '{n}' AS cls, {str(checks.ROW_CHECKS[n].hard).lower()} AS hard FROM pair WHERE {ROW_SQL[n]}" for n in COUNTED)
#: All row checks; and those alone that have SQL.
QUERIES |= {"finding_counts": _counts(list(checks.ROW_CHECKS)), "finding_totals": _totals(list(checks.ROW_CHECKS)), "finding_counts_in_sql": _counts(COUNTED), "finding_totals_in_sql": _totals(COUNTED)}
ORACLES["finding_counts_in_sql"] = f"WITH {PAIR_DAMAGED}, f AS ({_ALL}) SELECT cls, locale, count(*) AS n FROM f GROUP BY GROUPING SETS ((cls, locale), (cls))"
ORACLES["finding_totals_in_sql"] = f"WITH {PAIR_DAMAGED}, f AS ({_ALL}) SELECT hard, count(*) AS n, count(DISTINCT pos) AS rows, count(DISTINCT cls) AS classes FROM f GROUP BY hard"


def length_ratio_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.length_ratio_medians(pair_doc(spark, sf_dir)).select("locale", F.round("ratio", 9).alias("ratio"))


ORACLES["length_ratio_median"] = f"WITH {PAIR_DOC} SELECT locale, round(coalesce(median(CASE WHEN length(src) >= 8 THEN length(dst) / length(src) END), 1.0), 9) AS ratio FROM pair GROUP BY locale"


def msgstr_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds: translations short against all their sources, and those of sources that differ in a word."""
    return checks.msgstr_collapses(pair_doc(spark, sf_dir)).select("locale", "dst", C("n").cast("long").alias("n"), "pressed")


def msgstr_pressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first kind alone, which SQL can express."""
    return checks.msgstr_collapses(pair_doc(spark, sf_dir), substituted=False).select("locale", "dst", C("n").cast("long").alias("n"))


_KEY = "list_transform(list_filter(list_transform(regexp_extract_all(src, '[A-Za-z'']+'), lambda x: lower(x)), lambda x: x NOT IN ('a', 'an', 'the')), lambda x: CASE WHEN length(x) > 3 AND suffix(x, 's') AND NOT regexp_matches(x, '(?:ss|is|us|as)$') THEN x[:-2] ELSE x END)"
ORACLES["msgstr_pressed"] = rf"""WITH {PAIR_DOC}, p AS (SELECT pos, locale, src, regexp_replace(regexp_replace(dst, '^\s+', ''), '\s+$', '') AS t, dst AS d, {_KEY} AS k FROM pair),
 m AS (SELECT locale, coalesce(median(CASE WHEN length(src) >= 8 THEN length(d) / length(src) END), 1.0) AS ratio FROM p GROUP BY locale),
 g AS (SELECT locale, t, count(*) AS n, count(DISTINCT k) AS keys, min(length(src)) AS least FROM p GROUP BY locale, t)
 SELECT g.locale, g.t AS dst, g.n FROM g JOIN m ON g.locale = m.locale WHERE n > 1 AND keys > 1 AND length(t) < 0.6 * ratio * least"""


#: Both kinds: groups of sources with several keys that share a translation; two keys of as many words that differ in one, which is neither an inflection nor a synonym.
_ALIKE = " OR ".join(f"(x IN ('{a}', '{b}') AND y IN ('{a}', '{b}'))" for a, b in [*P.MORPH_PAIRS, *P.SYNONYM_PAIRS])
ORACLES["msgstr_collapse"] = rf"""WITH {PAIR_DOC}, p AS (SELECT pos, locale, src, regexp_replace(regexp_replace(dst, '^\s+', ''), '\s+$', '') AS t, dst AS d, {_KEY} AS k FROM pair),
 m AS (SELECT locale, coalesce(median(CASE WHEN length(src) >= 8 THEN length(d) / length(src) END), 1.0) AS ratio FROM p GROUP BY locale),
 g AS (SELECT locale, t, count(*) AS n, count(DISTINCT k) AS keys, min(length(src)) AS least FROM p GROUP BY locale, t HAVING count(*) > 1 AND count(DISTINCT k) > 1),
 u AS (SELECT DISTINCT p.locale, p.t, p.k FROM p JOIN g ON p.locale = g.locale AND p.t = g.t WHERE len(p.k) >= 4),
 b AS (SELECT a.locale, a.t, list_filter(list_zip(a.k, b.k), lambda z: z[1] <> z[2]) AS d FROM u a JOIN u b ON a.locale = b.locale AND a.t = b.t AND len(a.k) = len(b.k) AND a.k < b.k),
 o AS (SELECT locale, t, d[1][1] AS x, d[1][2] AS y FROM b WHERE len(d) = 1), q AS (SELECT DISTINCT locale, t FROM o WHERE NOT ({_ALIKE} OR ((starts_with(x, y) OR starts_with(y, x)) AND abs(length(x) - length(y)) <= 3)))
 SELECT g.locale, g.t AS dst, g.n, length(g.t) < 0.6 * ratio * least AS pressed FROM g JOIN m ON g.locale = m.locale LEFT JOIN q ON g.locale = q.locale AND g.t = q.t WHERE length(g.t) < 0.6 * ratio * least OR q.t IS NOT NULL"""


def crosswire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.crosswires(pair_doc(spark, sf_dir)).select("locale", "pos", C("best").cast("long").alias("best"))


_STOP = "(" + ", ".join(map(quoted, P.STOPWORDS)) + ")"


def _signature(t: str) -> str:
    return f"list_distinct(list_filter({words(t, '[A-Z][A-Za-z0-9]{2,}|[0-9]+')}, lambda x: x NOT IN {_STOP}))"


ORACLES["crosswire"] = f"""WITH {PAIR_DOC}, s AS (SELECT pos, locale, {_signature('src')} AS s, {_signature('dst')} AS d FROM pair),
 l AS (SELECT pos, locale, len(d) AS size, unnest(d) AS token FROM s WHERE len(s) >= 2 AND len(d) >= 2 AND NOT list_has_any(s, d)),
 r AS (SELECT pos AS near, locale AS l2, unnest(s) AS t2 FROM s),
 n AS (SELECT l.locale, l.pos, l.size, r.near, count(*) AS n FROM l JOIN r ON l.locale = r.l2 AND l.token = r.t2 AND abs(l.pos - r.near) <= 80 AND l.pos <> r.near GROUP BY ALL)
 SELECT locale, pos, max(n) AS best FROM n GROUP BY locale, pos, size HAVING max(n) >= 2 AND 2 * max(n) >= size"""


def antonym_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.antonym_collisions(pair_opposites(spark, sf_dir))
    return found.select("locale", "pos_a", "pos_b", C("n_a").cast("long").alias("n_a"), C("n_b").cast("long").alias("n_b"), "relation")


_POLAR = ", ".join(f"['{a}', '{b}']" for a, b in P.POLAR_PAIRS)
_BASES = "'" + "', '".join(P.NOT_POLAR) + "'"
_NEGATIONS = "[" + ", ".join(map(quoted, P.ENGLISH_NEGATION)) + "]"


def _is_polar(x: str, y: str) -> str:
    marked = lambda b, m: f"(length({b}) >= 3 AND {b} NOT IN ({_BASES}) AND {m} IN ('un' || {b}, 'in' || {b}, 'dis' || {b}))"
    return f"(list_contains([{_POLAR}], [{x}, {y}]) OR list_contains([{_POLAR}], [{y}, {x}]) OR {marked(x, y)} OR {marked(y, x)})"


ORACLES["antonym_collision"] = f"""WITH {PAIR_OPPOSITES}, r AS (SELECT locale, pos, dst AS t, list_transform(regexp_extract_all(src, '[A-Za-z'']+'), lambda x: lower(x)) AS w FROM pair),
 c AS MATERIALIZED (SELECT locale, t, w, min(pos) AS pos, count(*) AS n FROM r GROUP BY locale, t, w),
 p AS MATERIALIZED (SELECT a.locale, a.pos AS pos_a, b.pos AS pos_b, a.n AS n_a, b.n AS n_b, a.w AS x, b.w AS y, least(len(a.w), len(b.w)) AS k FROM c a JOIN c b ON a.locale = b.locale AND a.t = b.t AND a.pos < b.pos),
 d AS (SELECT *, list_filter(range(1, k + 1), lambda i: x[i] <> y[i]) AS d, abs(len(x) - len(y)) AS more, CASE WHEN len(x) > len(y) THEN x ELSE y END AS l, CASE WHEN len(x) > len(y) THEN y ELSE x END AS s FROM p),
 e AS (SELECT *, len(d) = 1 AND {_is_polar('x[d[1]]', 'y[d[1]]')} AS one, more BETWEEN 1 AND 2 AND len(list_filter(l, lambda v: list_contains({_NEGATIONS}, v))) > len(list_filter(s, lambda v: list_contains({_NEGATIONS}, v)))
   AND list_filter(l, lambda v: NOT list_contains({_NEGATIONS}, v)) = list_filter(s, lambda v: NOT list_contains({_NEGATIONS}, v)) AS neg FROM d),
 f AS (SELECT *, CASE WHEN one AND more = 0 AND k >= 1 THEN 'swap' WHEN one AND more > 0 AND k >= 3 THEN 'extended' WHEN neg THEN 'negation' END AS relation FROM e)
 SELECT locale, pos_a, pos_b, n_a, n_b, relation FROM f WHERE relation IS NOT NULL"""


def diacritic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged words of whole documents, as one string an entry."""
    return lost_marks.diacritics(pair_marks(spark, sf_dir)).select("locale", "pos", F.array_join("words", " ").alias("words"))


_FOLD = "replace(lower({w}), 'ß', 'ss')"
_SPELT_OUT = _FOLD.format(w="replace(replace(replace(replace(replace(replace(replace(replace({w}, 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'å', 'aa'), 'Ä', 'Ae'), 'Ö', 'Oe'), 'Ü', 'Ue'), 'Å', 'Aa')")
_MASK = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(dst, {quoted(PRINTF)}, ' ', 'g'), {quoted(f'({ANY})')}, {quoted(chr(92) + '1' + chr(92) + '1')}, 'g'), {quoted(f'(^|{ANY})(?:' + IDENT + f')({ANY}|$)')}, {quoted(chr(92) + '1 ' + chr(92) + '2')}, 'g'), {quoted(P.TOKEN)}, ' ', 'g'), {quoted(P.TAG)}, ' ', 'g')"
_LETTERS = r"[\p{L}\p{Nl}\p{No}]{3,}"


def _forms(w: str) -> str:
    return f"{_FOLD.format(w=w)} AS folded, strip_accents({_FOLD.format(w=w)}) AS plain, {_SPELT_OUT.format(w=w)} AS spelt"


ORACLES["diacritic"] = f"""WITH {PAIR_MARKS}, o AS MATERIALIZED (SELECT locale, pos, unnest({find(_MASK, _LETTERS)}) AS word FROM pair),
 c AS (SELECT locale, word, count(*) AS n FROM o GROUP BY ALL), v AS MATERIALIZED (SELECT *, folded = plain AND folded = spelt AS bare FROM (SELECT *, {_forms('word')} FROM c)),
 k AS (SELECT locale, plain AS key, bare, n FROM v UNION ALL SELECT locale, spelt, bare, n FROM v WHERE spelt <> folded),
 m AS (SELECT locale, key, coalesce(sum(n) FILTER (bare), 0) AS b, coalesce(sum(n) FILTER (NOT bare), 0) AS m FROM k GROUP BY ALL HAVING m > 0 AND m >= b),
 g AS (SELECT v.locale, word, folded, m >= 5 AND m >= 5 * b AS strong FROM v JOIN m ON v.locale = m.locale AND v.folded = m.key WHERE bare),
 f AS MATERIALIZED (SELECT DISTINCT o.locale, pos, o.word, folded, strong FROM o JOIN g ON o.locale = g.locale AND o.word = g.word WHERE folded NOT IN (SELECT strip_accents(lower(w)) FROM (SELECT unnest({find(quoted(MARKED_SOURCE), _LETTERS)}) AS w))),
 s AS (SELECT locale, pos FROM f GROUP BY ALL HAVING count(*) FILTER (strong) >= 2),
 r AS (SELECT locale, pos, unnest({find('dst', _LETTERS)}) AS word FROM pair JOIN s USING (locale, pos)),
 u AS (SELECT locale, pos FROM (SELECT locale, pos, {_forms('word')} FROM r) GROUP BY ALL HAVING bool_and(folded = plain AND folded = spelt)),
 d AS (SELECT DISTINCT locale, folded FROM f JOIN u USING (locale, pos))
 SELECT locale, pos, array_to_string(list_sort(list_distinct(list(folded))), ' ') AS words FROM f JOIN d USING (locale, folded) GROUP BY locale, pos"""


#: Our own agreed terms for the standard tables.
TERMS = [("token", "fr", ["jeton", "token"]), ("license", "de", ["Lizenz"]), ("mail", "es", ["correo"]), ("the", "en", ["The ", "the "])]


def term_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.term_consistency(pair_doc(spark, sf_dir), TERMS)


ORACLES["term_consistency"] = f"WITH {PAIR_DOC} " + " UNION ALL ".join(f"SELECT locale, pos, '{t}' AS term FROM pair WHERE locale = '{lo}' AND contains(lower(src), '{t}') AND NOT (" + " OR ".join(f"contains(dst, '{f}')" for f in forms) + ")" for t, lo, forms in TERMS)


def hidden_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.hidden_characters(pair_damaged(spark, sf_dir))


#: Hidden characters of a target, by code points: the SQL knows nothing of the checks' own classes.
_ZERO_WIDTH, _BIDI, _CONTROL = "c IN (8203, 8204, 8205, 8288, 65279, 6158)", "(c BETWEEN 8234 AND 8238 OR c BETWEEN 8294 AND 8297)", "(c BETWEEN 0 AND 8 OR c BETWEEN 14 AND 27 OR c IN (31, 127))"
HIDDEN_SQL = f"list_filter(list_transform(string_split(dst, ''), lambda x: unicode(x)), lambda c: ({_ZERO_WIDTH} OR c = 173 OR {_BIDI} OR c BETWEEN 8289 AND 8292 OR c BETWEEN 917504 AND 917631 OR {_CONTROL}) AND NOT (c = 8204 AND locale[1:3] IN ('fa_', 'ar_', 'ur_', 'ps_')))"
ORACLES["hidden_chars"] = f"""WITH {PAIR_DAMAGED}, h AS (SELECT locale, unnest({HIDDEN_SQL}) AS c FROM pair)
 SELECT locale, CASE WHEN {_ZERO_WIDTH} THEN 'zero_width' WHEN c = 173 THEN 'soft_hyphen' WHEN {_BIDI} THEN 'bidi_control' WHEN c BETWEEN 8289 AND 8292 THEN 'invisible_math' WHEN c >= 917504 THEN 'tag_character' ELSE 'ascii_control' END AS category, printf('%08X', c) AS code, count(*) AS n FROM h GROUP BY ALL"""


def mojibake_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.mojibake(pair_damaged(spark, sf_dir))


MOJIBAKE_SQL = "{n}(list_filter(regexp_extract_all(dst, '[\\x{{C2}}-\\x{{C5}}][\\x{{80}}-\\x{{FF}}]'), lambda x: unicode(x[2]) < 192))"
ORACLES["mojibake_find"] = f"WITH {PAIR_DAMAGED} SELECT pattern, count(*) AS n FROM (SELECT {MOJIBAKE_SQL.format(n='unnest')} AS pattern FROM pair) GROUP BY pattern"


def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pair_damaged(spark, sf_dir).filter(F.size(checks.mojibake_in(C("dst"))) > 0)
    return rows.select("pos", F.md5(checks.repaired_mojibake(C("dst"))).alias("md5"))


_PIECES = "regexp_extract_all(dst, '[\\x{C2}-\\x{C5}][\\x{80}-\\x{FF}]|(?s:.)')"
ORACLES["mojibake_repair"] = f"""WITH {PAIR_DAMAGED} SELECT pos, md5(array_to_string(list_transform({_PIECES}, lambda x: CASE WHEN length(x) = 2 AND unicode(x[2]) < 192 THEN chr((unicode(x[1]) % 32) * 64 + unicode(x[2]) % 64) ELSE x END), '')) AS md5
 FROM pair WHERE {MOJIBAKE_SQL.format(n='len')} > 0"""


def sentinel_leak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.sentinel_leaks(pair_damaged(spark, sf_dir))


def _sentinel(t: str) -> str:
    return "(" + " OR ".join(matches(t, p.replace("\\u2022", "\u2022")) for p in P.SENTINEL_LEAKS) + ")"


ORACLES["sentinel_leak"] = f"WITH {PAIR_DAMAGED} SELECT locale, pos FROM pair WHERE {_sentinel('dst')} AND NOT {_sentinel('src')}"


def mt_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.translation_artifacts(pair_damaged(spark, sf_dir)).select("locale", "pos", "ch", C("n").cast("long").alias("n"))


ORACLES["mt_artifacts"] = f"WITH {PAIR_DAMAGED} SELECT locale, pos, ch, count(*) AS n FROM (SELECT locale, pos, src, unnest(string_split(dst, '')) AS ch FROM pair) WHERE NOT contains(src, ch) AND (unicode(ch) BETWEEN 9833 AND 9839 OR unicode(ch) BETWEEN 119808 AND 120831 OR unicode(ch) BETWEEN 9472 AND 9599 OR unicode(ch) BETWEEN 9632 AND 10175 AND unicode(ch) NOT IN (9744, 9745, 9746) OR locale <> 'el_GR' AND (unicode(ch) BETWEEN 880 AND 1023 OR unicode(ch) BETWEEN 7936 AND 8191)) GROUP BY ALL"


def review_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the corrections replace an echo; the term DNSSEC is exempt in Russian."""
    rows = pair_damaged(spark, sf_dir).withColumn("old", F.when(C("pos") % 3 == 0, C("src")).when(C("pos") % 3 == 1, "x"))
    return checks.gated(rows, literals=[("DNSSEC", ["ru_RU"]), "user"], old="old").select("pos", "reasons")


_GATE_SPEC = r"%(?:[0-9]+\$)?[sdfucxXob]|%%"
_GATE = [
    ("placeholders", lists_differ(lambda t: f"list_transform({find(t, _GATE_SPEC)}, lambda x: regexp_replace(x, '[0-9]+\\$', ''))")),
    ("tags", ROW_SQL["tags"]), ("tokens", ROW_SQL["tokens"]),
    ("leading_space", r"regexp_extract(src, '^(\s*)', 1) <> regexp_extract(dst, '^(\s*)', 1)"),
    ("trailing_space", r"regexp_extract(src, '(\s*)$', 1) <> regexp_extract(dst, '(\s*)$', 1)"),
    ("identifiers", ROW_SQL["identifiers"]), ("addresses", f"list_sort({ips('src')}) <> list_sort({ips('dst')})"),
    ("literals", r"((regexp_matches(src, '(^|[^A-Za-z0-9_\\/-])DNSSECs?([^A-Za-z0-9_\\/-]|$)') AND NOT contains(lower(dst), 'dnssec') AND locale <> 'ru_RU') OR (regexp_matches(src, '(?i)(^|[^A-Za-z0-9_\\/-])users?([^A-Za-z0-9_\\/-]|$)') AND NOT contains(lower(dst), 'user')))"),
    ("fallback", "pos % 3 = 0"), ("empty", "trim(dst) = ''"), ("echo", "dst = src"),
]
ORACLES["review_gate"] = f"WITH {PAIR_DAMAGED}, r AS (SELECT pos, concat_ws('|', " + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in _GATE) + ") AS reasons FROM pair) SELECT pos, reasons FROM r WHERE reasons <> ''"


def echo_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.stats import issue_types

    rows = pair_page(spark, sf_dir).withColumn("issue", issue_types(C("src"), C("dst")))
    return rows.filter(C("issue").isNotNull()).groupBy("locale", "issue").agg(F.count("*").alias("n"))


ORACLES["issue_types"] = f"WITH {PAIR_PAGE} SELECT locale, CASE WHEN dst = '' THEN 'empty' ELSE 'untranslated' END AS issue, count(*) AS n FROM pair WHERE dst = '' OR dst = src GROUP BY ALL"
QUERIES |= {
    "length_ratio_median": length_ratio_median, "msgstr_collapse": msgstr_collapse, "msgstr_pressed": msgstr_pressed, "crosswire": crosswire, "antonym_collision": antonym_collision,
    "diacritic": diacritic, "term_consistency": term_consistency, "hidden_chars": hidden_chars, "mojibake_find": mojibake_find, "mojibake_repair": mojibake_repair,
    "mt_artifacts": mt_artifacts, "sentinel_leak": sentinel_leak, "review_gate": review_gate, "issue_types": echo_issues,
}
