"""Queries of the catalogue operators over entries made from the rows of `part`, and over damaged pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import catalogue, ordered
from .check_queries import HIDDEN_SQL, MOJIBAKE_SQL
from .pairs import PAIR_DAMAGED, pair_damaged, table

C = F.col
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


LOCALES = ["en_EN", "fr_FR", "de_DE", "xx_XX", "es_ES"]
RULES = {"en": "nplurals=2; plural=(n != 1);", "fr": "nplurals=2; plural=(n > 1);", "de": "nplurals=2; plural=(n != 1);", "es": "nplurals=2; plural=(n != 1);"}
EXCLUDED = ["API", "DNS"]


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entry a part: every third a plural, some empty, some echoes, some fuzzy, some obsolete."""
    k = C("p_partkey")
    rows = table(spark, sf_dir, "part").select(k, F.get(F.array(*map(F.lit, LOCALES)), (k % 5).cast("int")).alias("locale"), F.when(k % 13 == 0, "API").otherwise(F.concat("p_name", F.lit(" "), k.cast("string"))).alias("msgid"))
    several = F.floor(k / 5) % 3 == 0
    text = F.when(k % 4 == 0, "").when(k % 4 == 1, C("msgid")).otherwise(F.concat(F.lit("trad "), "msgid"))
    forms = F.when(k % 8 == 2, F.create_map(F.lit(0), text)).otherwise(F.create_map(F.lit(0), text, F.lit(1), F.concat(F.lit("trads "), "msgid")))
    return rows.select(
        "locale", F.concat("locale", F.lit(".po")).alias("path"), k.alias("pos"), "msgid", F.when(several, F.concat("msgid", F.lit("s"))).otherwise("").alias("msgid_plural"),
        F.when(several, "").otherwise(text).alias("msgstr"), F.when(several, forms).otherwise(F.create_map().cast("map<int,string>")).alias("plurals"),
        (k % 7 == 0).alias("is_fuzzy"), (k % 11 == 0).alias("obsolete"), F.lit(False).alias("is_header"), F.lit("\n\n").alias("sep"),
        F.array(F.concat(F.lit("src/a.php:"), k.cast("string")), F.lit("b:1")).alias("locations"), F.when(k % 2 == 0, F.array(F.lit("note"))).otherwise(F.array().cast("array<string>")).alias("comments"),
    )


_ENTRIES = """b AS (SELECT p_partkey AS pos, ['en_EN', 'fr_FR', 'de_DE', 'xx_XX', 'es_ES'][p_partkey % 5 + 1] AS locale, CASE WHEN p_partkey % 13 = 0 THEN 'API' ELSE p_name || ' ' || p_partkey END AS msgid, (p_partkey // 5) % 3 = 0 AS several FROM part),
 t AS (SELECT *, CASE pos % 4 WHEN 0 THEN '' WHEN 1 THEN msgid ELSE 'trad ' || msgid END AS t, pos % 7 = 0 AS fuzzy, pos % 11 = 0 AS obsolete, pos % 8 = 2 AS short FROM b),
 e AS (SELECT *, t = '' OR (locale <> 'en_EN' AND t = msgid) AS open FROM t)"""


@query(f"""WITH {_ENTRIES} SELECT locale, pos, CASE WHEN several THEN 0 ELSE -1 END AS form, CASE WHEN t = '' THEN 'empty' ELSE 'untranslated' END || CASE WHEN several THEN '_plural' ELSE '' END AS issue
 FROM e WHERE open AND NOT obsolete AND msgid <> 'API'""")
def entry_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.issues(entries(spark, sf_dir), EXCLUDED)


@query(f"""WITH {_ENTRIES}, f AS (SELECT locale, t = '' AS none FROM e WHERE open AND NOT obsolete AND msgid <> 'API'), c AS (SELECT locale, count(*) FILTER (none) AS empty, count(*) FILTER (NOT none) AS untranslated FROM f GROUP BY locale)
 SELECT locale, coalesce(empty, 0) AS empty, coalesce(untranslated, 0) AS untranslated, coalesce(c.empty + c.untranslated, 0) = 0 AS clean FROM (SELECT DISTINCT locale FROM e) LEFT JOIN c USING (locale)""")
def issue_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entries(spark, sf_dir)
    return catalogue.issue_report(rows, catalogue.issues(rows, EXCLUDED))


@query(f"""WITH {_ENTRIES} SELECT locale, count(*) FILTER (open AND NOT fuzzy AND msgid <> 'API') AS untranslated_count, count(*) FILTER (fuzzy AND msgid <> 'API') AS fuzzy_count,
 count(*) FILTER ((open OR fuzzy) AND msgid = 'API') AS excluded_count, count(*) FILTER (open AND msgid <> 'API') AS total_untranslated FROM e WHERE NOT obsolete GROUP BY locale""")
def export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.export_counts(entries(spark, sf_dir), EXCLUDED)


@query(f"""WITH {_ENTRIES}, s AS (SELECT *, CASE WHEN fuzzy THEN 'fuzzy' ELSE 'untranslated' END AS section FROM e WHERE NOT obsolete AND msgid <> 'API' AND (open OR fuzzy)), r AS (SELECT *, row_number() OVER (PARTITION BY locale, section ORDER BY pos) AS k FROM s) SELECT locale, section, pos, '{{"locations":["src/a.php:' || pos || '","b:1"],"msgid":"' || msgid || '"' || CASE WHEN fuzzy THEN ',"current_translation":"' || CASE WHEN several THEN '' ELSE t END || '"' ELSE '' END || ',"translation":""' ||
 CASE WHEN several THEN ',"msgid_plural":"' || msgid || 's"' || CASE WHEN fuzzy THEN ',"current_translations":{{"0":"' || t || '"' || CASE WHEN short THEN '' ELSE ',"1":"trads ' || msgid || '"' END || '}}' ELSE '' END || ',"translations":{{}}' ELSE '' END || CASE WHEN pos % 2 = 0 THEN ',"comments":["note"]' ELSE '' END || '}}' AS entry FROM r WHERE k <= 20""")
def export_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty of each section, as the export's limit has it."""
    return catalogue.exported(entries(spark, sf_dir), EXCLUDED, 20)


def _declared(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x, 2) for x in LOCALES], "locale string, nplurals int")


def _given(rows: DataFrame) -> DataFrame:
    """Texts for singulars, forms for plurals, but a bare text or too few forms for some plurals in xx_XX and es_ES."""
    new, several = F.concat(F.lit("neu "), "msgid"), C("msgid_plural") != ""
    bare, few = (C("locale") == "xx_XX") & (C("pos") % 2 == 0), (C("locale") == "es_ES") & (C("pos") % 2 == 0)
    forms = F.when(few, F.create_map(F.lit("0"), new)).otherwise(F.create_map(F.lit("0"), new, F.lit("1"), new))
    return rows.filter(C("msgid") != "API").select("locale", "msgid", F.when(~several | bare, new).alias("text"), F.when(several & ~bare, forms).alias("forms"))


@query(f"""WITH {_ENTRIES}, n AS (SELECT * FROM e WHERE NOT obsolete AND msgid <> 'API' AND (open OR fuzzy)) SELECT locale, pos, 'payload' AS outcome FROM n WHERE locale NOT IN (SELECT locale FROM n WHERE several AND pos % 2 = 0 AND locale IN ('xx_XX', 'es_ES'))
 UNION ALL SELECT locale, pos, CASE locale WHEN 'xx_XX' THEN 'needs_forms' ELSE 'other_forms' END FROM n WHERE several AND pos % 2 = 0 AND locale IN ('xx_XX', 'es_ES')""")
def dict_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entries(spark, sf_dir)
    payload, rejected = catalogue.dict_payload(rows, _given(rows), _declared(spark))
    return payload.select("locale", "pos", F.lit("payload").alias("outcome")).unionByName(rejected.select("locale", "pos", C("reason").alias("outcome")))


@query(f"""WITH {_ENTRIES}, n AS (SELECT locale, msgid, 1 + (pos % 9 = 3)::INT AS form, several, obsolete, pos % 10 = 8 AS two FROM e WHERE msgid <> 'API' AND (several OR pos % 10 = 1)),
 r AS (SELECT locale, msgid, form, CASE WHEN two THEN 'conflict' WHEN obsolete THEN 'unknown' WHEN NOT several THEN 'not_plural' WHEN form > 1 THEN 'index' END AS reasons FROM n) SELECT * FROM r WHERE reasons IS NOT NULL""")
def plural_fix_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entries(spark, sf_dir).filter((C("msgid") != "API") & ((C("msgid_plural") != "") | (C("pos") % 10 == 1)))
    form = F.lit(1) + (C("pos") % 9 == 3).cast("int")
    texts = F.when(C("pos") % 10 == 8, F.array(F.lit("eins"), F.lit("zwei"))).otherwise(F.array(F.concat(F.lit("neu "), "msgid")))
    proposals = rows.select("locale", "msgid", form.alias("form"), F.explode(texts).alias("text"))
    return catalogue.plural_fixes(entries(spark, sf_dir), proposals, _declared(spark))[1]


@query(f"""WITH {_ENTRIES}, k AS (SELECT * FROM e WHERE NOT obsolete AND (msgid = 'API' OR pos % 3 <> 0)), l AS (SELECT locale, max(pos) AS last FROM k GROUP BY locale) SELECT k.locale, pos, pos = last AS single FROM k JOIN l ON k.locale = l.locale""")
def obsolete_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entries(spark, sf_dir)
    template = rows.filter((C("pos") % 3 != 0) | (C("msgid") == "API")).select("msgid")
    return catalogue.without_obsolete(rows, template).select("locale", "pos", (C("sep") == "\n").alias("single"))


@query(f"""WITH {_ENTRIES} SELECT locale, pos, 'forms' AS fault FROM e WHERE several AND NOT obsolete AND short AND locale IN ('en_EN', 'fr_FR', 'de_DE')
 UNION ALL SELECT 'de_DE', NULL, 'other_rule' UNION ALL SELECT 'xx_XX', NULL, 'unknown_language' UNION ALL SELECT 'es_ES', NULL, 'no_rule'""")
def plural_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entries(spark, sf_dir)
    rule = lambda r: catalogue.header_text([("Language", F.lit("x")), ("Plural-Forms", F.lit(r))])
    heads = spark.createDataFrame([(x,) for x in LOCALES[:4]], "locale string")
    text = F.when(C("locale").isin("fr_FR", "de_DE"), rule("nplurals=2; plural=n>1;")).otherwise(rule("nplurals=2; plural=n!=1;"))
    heads = heads.select("locale", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("msgid"), F.lit("").alias("msgid_plural"), text.alias("msgstr"), F.create_map().cast("map<int,string>").alias("plurals"), F.lit(False).alias("obsolete"), F.lit(True).alias("is_header"))
    return catalogue.plural_forms(rows.select(heads.columns).unionByName(heads), RULES)


@query("SELECT p_partkey, md5('Language: fr' || chr(10) || 'X-Note: a$1' || chr(92) || 'b ' || p_name || chr(10)) AS replaced, p_name AS value FROM part")
def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").withColumn("head", catalogue.header_text([("Language", F.lit("fr")), ("X-Note", C("p_name"))]))
    new = catalogue.with_header_field(C("head"), "X-Note", F.concat(F.lit("a$1\\b "), "p_name"))
    return rows.select("p_partkey", F.md5(new).alias("replaced"), catalogue.header_field(C("head"), "X-Note").alias("value"))


@query(f"WITH {_ENTRIES} SELECT msgid FROM e WHERE NOT obsolete UNION SELECT msgid || 's' FROM e WHERE NOT obsolete AND several UNION SELECT s_name FROM supplier")
def message_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = table(spark, sf_dir, "supplier").select(C("s_name").alias("msgid"), F.lit(None).cast("string").alias("msgid_plural"), F.lit(False).alias("obsolete"), F.lit(False).alias("is_header"))
    return catalogue.message_corpus(entries(spark, sf_dir), other)


@query("SELECT DISTINCT p_type AS name FROM part WHERE p_partkey % 3 <> 0 AND regexp_full_match(p_type, '[A-Z][A-Z0-9]*')")
def constant_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(C("p_partkey") % 3 == 0, "OTHER").otherwise(C("p_type"))
    text = F.concat(F.lit("<?php\n    public const "), "p_type", F.lit(" = '"), value, F.lit("';\n"))
    return catalogue.constants(table(spark, sf_dir, "part").select(text.alias("text")), "text")


GLOSSARY = [("DNSSEC", []), ("user_name_id", ["fr"]), ("NSEC3", ["de"]), ("bold", []), ("https", [])]
_EDGE = r"[^A-Za-z0-9_\\/-]"


def _dropped(term: str, exempt: list[str]) -> str:
    fold = "" if term != term.lower() else "(?i)"
    locales = "".join(f" AND locale <> '{x}'" for x in exempt)
    return rf"SELECT locale, pos, '{term}' AS term FROM pair WHERE regexp_matches(src, '{fold}(^|{_EDGE}){term}s?({_EDGE}|$)') AND NOT contains(lower(regexp_replace(dst, '\s*/\s*', '/', 'g')), '{term.lower()}'){locales}"


@query(f"WITH {PAIR_DAMAGED} " + " UNION ALL ".join(_dropped(*x) for x in GLOSSARY))
def glossary_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.dropped_terms(pair_damaged(spark, sf_dir), GLOSSARY)


_WORDS = r"SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS term FROM benchmark"


@query(rf"""WITH t AS ({_WORDS}), w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+')) AS term FROM documents), g AS (SELECT CASE WHEN length(term) > 4 THEN 'long' ELSE 'short' END AS "group", term FROM t WHERE term IN (SELECT term FROM w))
 SELECT "group", term, '{{"term":"' || term || '","group":"' || "group" || '","note":"","source":"benchmark"}}' AS entry FROM g""")
def glossary_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = table(spark, sf_dir, "benchmark").select(F.explode(T.find(C("text"), r"[\p{L}\p{N}]+")).alias("term"))
    terms = terms.select(F.when(F.length("term") > 4, "long").otherwise("short").alias("group"), "term", F.lit("").alias("note"), F.lit("benchmark").alias("source"))
    return catalogue.glossary_document(terms, table(spark, sf_dir, "documents"))


_SYMBOL = "NOT contains(src, ch) AND (unicode(ch) BETWEEN 9833 AND 9839 OR unicode(ch) BETWEEN 119808 AND 120831 OR unicode(ch) BETWEEN 9472 AND 9599 OR unicode(ch) BETWEEN 9632 AND 10175 AND unicode(ch) NOT IN (9744, 9745, 9746) OR locale <> 'el_GR' AND (unicode(ch) BETWEEN 880 AND 1023 OR unicode(ch) BETWEEN 7936 AND 8191))"
_MARKS = f"a AS (SELECT locale, pos, ch, count(*) AS n FROM (SELECT locale, pos, src, unnest(string_split(dst, '')) AS ch FROM pair) WHERE {_SYMBOL} GROUP BY ALL)"


@query(f"""WITH {PAIR_DAMAGED}, {_MARKS}, o AS (SELECT locale, sum({MOJIBAKE_SQL.format(n='len')}) AS m, sum(len({HIDDEN_SQL})) AS h FROM pair GROUP BY locale), r AS (SELECT m, h, (SELECT coalesce(sum(n), 0) FROM a WHERE a.locale = o.locale) AS s FROM o)
 SELECT count(*) AS scanned, count(*) FILTER (m + h + s > 0) AS affected, sum(m)::BIGINT AS mojibake, sum(h)::BIGINT AS hidden, sum(s)::BIGINT AS artifacts FROM r""")
def unicode_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.rollup(pair_damaged(spark, sf_dir))


@query(f"WITH {PAIR_DAMAGED}, w AS (SELECT pos, unnest(regexp_extract_all(dst, '[A-Z]{{2,}}')) AS pattern FROM pair), c AS (SELECT pattern, count(*) AS n, min(pos) AS f FROM w GROUP BY pattern) SELECT pattern, n, greatest((SELECT count(*) FROM c) - 6, 0) AS more FROM c ORDER BY n DESC, f, pattern LIMIT 6")
def top_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six most frequent runs of capitals: the report's own limit."""
    return catalogue.top_patterns(pair_damaged(spark, sf_dir).select("pos", F.explode(T.find(C("dst"), "[A-Z]{2,}")).alias("run")), "run", "pos")


@query(f"WITH {PAIR_DAMAGED}, {_MARKS} SELECT locale, pos, string_agg(ch || 'x' || n, ' ' ORDER BY ch) AS chars FROM a GROUP BY locale, pos")
def suspect_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.transform(F.map_entries("chars"), lambda x: F.concat(x["key"], F.lit("x"), x["value"].cast("string")))
    return catalogue.suspect_characters(pair_damaged(spark, sf_dir)).select("locale", "pos", F.array_join(shown, " ").alias("chars"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = C("p_partkey")
    quoted = F.concat(F.when(k % 3 == 0, 'msgid "').when(k % 6 == 1, 'msgstr[1] "').otherwise('msgstr "'), "p_name", F.lit('"'))
    return table(spark, sf_dir, "part").select(C("p_brand").alias("path"), k.alias("line"), F.when(k % 10 == 9, "# comment").otherwise(quoted).alias("text"))


_LINES = """l AS (SELECT p_brand AS path, p_partkey AS line, p_name, p_partkey % 10 = 9 AS comment, p_partkey % 3 = 0 AS id FROM part)"""


@query(f"WITH {_LINES}, c AS (SELECT *, last_value(CASE WHEN id AND NOT comment THEN p_name END IGNORE NULLS) OVER (PARTITION BY path ORDER BY line) AS msgid FROM l) SELECT path, line, msgid, p_name AS msgstr FROM c WHERE NOT id AND NOT comment")
def carried_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.carried_ids(_lines(spark, sf_dir), "path", "line", "text")


_QUOTED = r"""l AS (SELECT source AS path, doc_id * 100000 + generate_subscripts(string_split(text, chr(10)), 1) AS line, unnest(string_split(text, chr(10))) AS t, doc_id FROM documents),
 k AS (SELECT path, line, CASE WHEN line % 5 = 1 THEN 'msgid "' || left(t, 12) || '"' WHEN line % 5 = 2 THEN '"' || t || '"' WHEN line % 5 = 3 THEN 'msgstr "' || t || '"' WHEN line % 5 = 4 THEN '"' || doc_id || '"' WHEN line % 3 = 0 THEN '' ELSE '# ' || t END AS t FROM l),
 e AS (SELECT *, count(*) FILTER (starts_with(t, 'msgid "')) OVER (PARTITION BY path ORDER BY line) AS e FROM k),
 q AS (SELECT *, CASE WHEN starts_with(t, 'msgid "') THEN 'i' WHEN starts_with(t, 'msgstr "') THEN 's' WHEN t = '' THEN 'e' WHEN starts_with(t, '"') THEN 'm' END AS kind FROM e WHERE e > 0),
 o AS (SELECT *, last_value(CASE WHEN kind <> 'm' THEN kind END IGNORE NULLS) OVER (PARTITION BY path, e ORDER BY line) AS open, max(CASE WHEN kind = 's' THEN line END) OVER (PARTITION BY path, e ORDER BY line) AS str FROM q WHERE kind IS NOT NULL),
 z AS (SELECT path, e, min(line) AS closed FROM o WHERE kind = 'e' AND str IS NOT NULL GROUP BY path, e),
 w AS (SELECT o.* FROM o LEFT JOIN z ON o.path = z.path AND o.e = z.e WHERE z.closed IS NULL OR line < closed),
 f AS (SELECT path, e, string_agg(CASE kind WHEN 'i' THEN t[7:] ELSE t END, chr(10) ORDER BY line) FILTER (open = 'i') AS msgid, string_agg(CASE kind WHEN 's' THEN t[8:] ELSE t END, chr(10) ORDER BY line) FILTER (open = 's') AS msgstr FROM w GROUP BY path, e)"""


@query(rf"""WITH {_QUOTED} SELECT path, md5(regexp_replace(msgid, '^\s+|\s+$', '', 'g')) AS id, md5(regexp_replace(arg_max(msgstr, e), '^\s+|\s+$', '', 'g')) AS str FROM f WHERE msgid <> '""' AND msgstr IS NOT NULL GROUP BY path, msgid""")
def quoted_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of the documents as lines of a catalogue a source, read back as a map of quoted texts."""
    docs = table(spark, sf_dir, "documents").select(C("source").alias("path"), "doc_id", F.posexplode(F.split("text", "\n")).alias("_i", "t"))
    line = C("doc_id") * 100_000 + C("_i") + 1
    quoted = lambda word, t: F.concat(F.lit(f'{word}"'), t, F.lit('"'))
    text = (
        F.when(line % 5 == 1, quoted("msgid ", F.left("t", F.lit(12)))).when(line % 5 == 2, quoted("", C("t"))).when(line % 5 == 3, quoted("msgstr ", C("t")))
        .when(line % 5 == 4, quoted("", C("doc_id").cast("string"))).when(line % 3 == 0, "").otherwise(F.concat(F.lit("# "), "t"))
    )
    return ordered.quoted_map(docs.select("path", line.alias("line"), text.alias("text"))).select("path", F.md5("msgid").alias("id"), F.md5("msgstr").alias("str"))


@query(f"""WITH {_LINES}, k AS (SELECT path, line, CASE WHEN id THEN 'msgid "' WHEN line % 6 = 1 THEN 'msgstr[1] "' ELSE 'msgstr "' END || p_name || '"' AS t, row_number() OVER (PARTITION BY path ORDER BY line) - 1 AS no FROM l WHERE NOT comment),
 b AS (SELECT path, no // 3 AS part, md5(string_agg(t, chr(10) ORDER BY line)) AS d FROM k GROUP BY ALL) SELECT path, md5(string_agg(d, '' ORDER BY part)) AS md5 FROM b GROUP BY path""")
def filtered_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In blocks of three lines, so that files have several."""
    return catalogue.filtered_digests(_lines(spark, sf_dir), "path", "line", "text", "^#", block=3)


@query("SELECT sum(event_id % 50)::BIGINT AS translated, coalesce(sum(event_id % 7) FILTER (event_id % 2 = 0), 0)::BIGINT AS fuzzy, sum(event_id % 3)::BIGINT AS untranslated FROM events")
def statistics_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = lambda m: (C("event_id") % m).cast("string")
    fuzzy = F.when(C("event_id") % 2 == 0, F.concat(number(7), F.lit(" fuzzy translations, "))).otherwise("")
    text = F.concat(number(50), F.lit(" translated messages, "), fuzzy, number(3), F.lit(" untranslated messages."))
    return catalogue.statistics_counts(table(spark, sf_dir, "events").select(text.alias("text")), "text")


@query(f"WITH {_ENTRIES} SELECT count(DISTINCT msgid) AS missing FROM e WHERE msgid NOT IN (SELECT msgid FROM e WHERE NOT obsolete)")
def missing_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entries(spark, sf_dir)
    return catalogue.missing_count(rows, catalogue.live(rows))
