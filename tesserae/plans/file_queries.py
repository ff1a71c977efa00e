"""Queries of catalogue and source files: written from the given tables into the shared folder, then read as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.similarity import display_domain_udf
from ..operators import catalogue, relational, rewrite
from ..sources import files, mo, po, pot
from ..sources.shared import shared_dir
from . import catalogue_queries
from .catalogue_queries import _ENTRIES
from .pairs import table

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


# --- catalogues ------------------------------------------------------------------------------


def _block(entry_text: Column) -> Column:
    """A block's text: places, flags, strings; obsolete ones behind #~."""
    several = C("msgid_plural") != ""
    forms = F.array_join(F.transform(F.array_sort(F.map_keys("plurals")), lambda k: F.concat(pot.quoted("msgstr[#]", F.element_at("plurals", k)), F.lit("\u0001"), k.cast("string"))), "\n")
    forms = F.regexp_replace(forms, "msgstr\\[#\\]((?s:.)*?)\u0001(\\d+)", "msgstr[$2]$1")
    strings = F.when(several, F.concat(pot.quoted("msgid", entry_text), F.lit("\n"), pot.quoted("msgid_plural", C("msgid_plural")), F.lit("\n"), forms)).otherwise(F.concat(pot.quoted("msgid", entry_text), F.lit("\n"), pot.quoted("msgstr", C("msgstr"))))
    head = F.concat(F.lit("# note\n#: "), F.array_join("locations", " "), F.lit("\n"), F.when(C("is_fuzzy"), "#, fuzzy, c-format\n").otherwise(""))
    return F.when(C("obsolete"), F.concat(F.lit("#~ "), F.replace(strings, F.lit("\n"), F.lit("\n#~ ")))).otherwise(F.concat(head, strings))


def _written(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The entries of `part` as a catalogue a locale, with a header, in a folder of text files; every msgid has a line feed and quotes in it."""
    rows = catalogue_queries.entries(spark, sf_dir).withColumn("msgid", F.concat("msgid", F.lit('\n"q"\t')))
    rows = rows.withColumn("msgid_plural", F.when(C("msgid_plural") == "", "").otherwise(F.concat("msgid", F.lit("s"))))
    blocks = rows.select("locale", "pos", _block(C("msgid")).alias("text"))
    heads = rows.select("locale").distinct().select("locale", F.lit(-1).cast("long").alias("pos"), F.concat(F.lit('msgid ""\nmsgstr ""\n"Language: '), "locale", F.lit('\\n"')).alias("text"))
    folder = shared_dir(spark)
    lines = heads.unionByName(blocks).repartition("locale").sortWithinPartitions("locale", "pos")
    lines.select("locale", F.concat("text", F.lit("\n")).alias("text")).write.partitionBy("locale").text(folder)
    return rows, folder


_PO = f"""{_ENTRIES}, g AS (SELECT *, msgid || chr(10) || '"q"' || chr(9) AS id FROM e), h AS (SELECT *, 'locale=' || locale AS loc FROM g)"""


@query(f"""WITH {_PO} SELECT loc AS locale, md5(CASE WHEN obsolete THEN '' ELSE id END) AS msgid, CASE WHEN obsolete THEN '' WHEN several THEN md5(id || 's') ELSE '' END AS msgid_plural, CASE WHEN obsolete THEN '' WHEN several THEN '0' || md5(t) || CASE WHEN short THEN '' ELSE '1' || md5('trads ' || msgid) END ELSE md5(t) END AS texts,
 fuzzy AND NOT obsolete AS is_fuzzy, obsolete, CASE WHEN obsolete THEN md5(id) ELSE '' END AS obsolete_msgid, CASE WHEN obsolete THEN '' ELSE 'src/a.php:' || pos || ' b:1' END AS places FROM h
 UNION ALL SELECT DISTINCT loc, md5(''), '', md5('Language: ' || locale || chr(10)), false, false, '', '' FROM h""")
def po_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue files of all entries, read back through the parser."""
    _, folder = _written(spark, sf_dir)
    rows = po.read_po(spark, f"{folder}/*/part-*", once=True)
    forms = F.array_join(F.transform(F.array_sort(F.map_keys("plurals")), lambda k: F.concat(k.cast("string"), F.md5(F.element_at("plurals", k)))), "")
    locale = F.regexp_extract("path", "(locale=[^/]*)/[^/]*$", 1)
    digest = lambda c: F.when(F.coalesce(C(c), F.lit("")) == "", "").otherwise(F.md5(c))
    return rows.select(
        locale.alias("locale"), F.md5("msgid").alias("msgid"), digest("msgid_plural").alias("msgid_plural"), F.when(C("obsolete"), "").when(F.size("plurals") > 0, forms).otherwise(F.md5("msgstr")).alias("texts"),
        "is_fuzzy", "obsolete", digest("obsolete_msgid").alias("obsolete_msgid"), F.array_join("locations", " ").alias("places"),
    )


@query(f"""WITH {_PO}, c AS (SELECT loc, count(*) + 1 AS blocks, count(*) FILTER (NOT obsolete AND NOT several AND t = '') AS changed FROM h GROUP BY loc) SELECT loc AS locale, blocks, changed, 0::BIGINT AS other FROM c""")
def po_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty singulars filled in all catalogues, which are written and read again: only these blocks differ, in their last line alone."""
    _, folder = _written(spark, sf_dir)
    before = po.read_po(spark, f"{folder}/*/part-*", once=True)
    empty = ~C("obsolete") & ~C("is_header") & (F.size("plurals") == 0) & (C("msgstr") == "")
    filled = before.withColumns({"dirty": empty, "msgstr": F.when(empty, F.concat(F.lit("filled "), C("pos").cast("string"))).otherwise(C("msgstr"))})
    again = shared_dir(spark)
    texts = po.catalogue_text(filled).select(F.regexp_extract("path", "locale=([^/]*)/[^/]*$", 1).alias("locale"), F.regexp_replace("content", r"\n\z", "").alias("content"))
    texts.write.partitionBy("locale").text(again)
    after = po.read_po(spark, f"{again}/*/part-*", once=True)
    key = lambda df, n: df.select(F.regexp_extract("path", "(locale=[^/]*)/[^/]*$", 1).alias(f"l{n}"), C("pos").alias(f"p{n}"), C("raw").alias(f"r{n}"), C("msgstr").alias(f"m{n}"))
    both = key(before, 1).join(key(after, 2), (C("l1") == C("l2")) & (C("p1") == C("p2")), "full_outer")
    differs = ~C("r1").eqNullSafe(C("r2"))
    asked = differs & (C("r2") == F.regexp_replace("r1", 'msgstr ""$', F.concat(F.lit('msgstr "filled '), C("p1").cast("string"), F.lit('"'))))
    return both.groupBy(F.coalesce("l1", "l2").alias("locale")).agg(F.count("*").alias("blocks"), F.count_if(asked).alias("changed"), F.count_if(differs & ~asked).alias("other"))


@query(f"""WITH {_PO}, v AS (SELECT locale, pos, unnest(CASE WHEN several THEN CASE WHEN short THEN [[0::VARCHAR, id, t]] ELSE [[0::VARCHAR, id, t], ['1', id || 's', 'trads ' || msgid]] END ELSE [['-1', id, t]] END) AS v FROM h WHERE NOT obsolete)
 SELECT locale, v[1]::INT AS form, count(*) AS n, count(DISTINCT v[2]) AS sources FROM v WHERE v[3] <> '' AND v[3] <> v[2] GROUP BY ALL""")
def po_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = _written(spark, sf_dir)
    rows = po.views(po.read_po(spark, f"{folder}/*/part-*", once=True).withColumn("locale", F.regexp_extract("path", "locale=([^/]*)/[^/]*$", 1)))
    return rows.groupBy("locale", "form").agg(F.count("*").alias("n"), F.count_distinct("src").alias("sources"))


@query(f"""WITH {_PO} SELECT locale, md5(id || CASE WHEN several THEN chr(1) || id || 's' ELSE '' END) AS key, md5(t || CASE WHEN several AND NOT short THEN chr(1) || 'trads ' || msgid ELSE '' END) AS value FROM (SELECT *, row_number() OVER (PARTITION BY locale, id, several ORDER BY pos DESC) AS last FROM h WHERE NOT obsolete AND NOT fuzzy AND (t <> '' OR (several AND NOT short))) WHERE last = 1
 UNION ALL SELECT DISTINCT locale, md5(''), md5('Language: ' || locale || chr(10)) FROM h""")
def mo_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All catalogues compiled and decoded again; NUL is shown as another control character."""
    _, folder = _written(spark, sf_dir)
    entries = po.read_po(spark, f"{folder}/*/part-*", once=True)
    rows = mo.decoded(mo.compiled(entries))
    shown = lambda c: F.md5(F.replace(C(c), F.lit("\x00"), F.lit("\x01")))
    return rows.select(F.regexp_extract("path", "locale=([^/]*)/[^/]*$", 1).alias("locale"), shown("key").alias("key"), shown("value").alias("value"))


@query(f"WITH {_ENTRIES}, s AS (SELECT locale, pos > min(pos) OVER (PARTITION BY locale, msgid) AS twice FROM e WHERE NOT obsolete AND NOT fuzzy) SELECT locale, count(*) AS n FROM s WHERE twice GROUP BY locale")
def strict_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a strict compiler refuses: the exclusion that stands in a catalogue many times."""
    rows = mo.faults(catalogue_queries.entries(spark, sf_dir).withColumn("msgctxt", F.lit(None).cast("string")))
    return rows.filter(C("fault") == "duplicate").groupBy(F.regexp_replace("path", r"\.po$", "").alias("locale")).agg(F.count("*").alias("n"))


@query(f"""WITH {_ENTRIES}, d AS (SELECT DISTINCT msgid FROM e WHERE pos % 3 <> 0), n AS (SELECT e.*, d.msgid IS NOT NULL AS has FROM e LEFT JOIN d ON e.msgid = d.msgid WHERE locale = 'fr_FR')
 SELECT pos, CASE WHEN obsolete THEN NULL WHEN has AND NOT several THEN 'translated' ELSE 'source' END AS source, CASE WHEN obsolete THEN NULL WHEN several THEN (CASE WHEN has THEN 'ru ' || msgid ELSE msgid END) || '|' || msgid || 's|' || msgid || 's' ELSE CASE WHEN has THEN 'ru ' || msgid ELSE msgid END END AS texts FROM n""")
def locale_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue as a new locale's with three plural forms, from translations of two thirds of the singulars."""
    rows = catalogue_queries.entries(spark, sf_dir)
    done = rows.filter(C("pos") % 3 != 0).select(C("msgid").alias("source"), F.concat(F.lit("ru "), "msgid").alias("translation"))
    built = catalogue.new_locale(rows.filter(C("locale") == "fr_FR"), done, "ru_RU", "nplurals=3; plural=(n%10==1 ? 0 : n%10>=2 ? 1 : 2);")
    forms = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.element_at("plurals", k)), "|")
    return built.select("pos", "source", F.when(C("source").isNull(), None).when(C("msgid_plural") != "", forms).otherwise(C("msgstr")).alias("texts"))


@query(f"WITH {_ENTRIES}, s AS (SELECT locale, obsolete, CASE WHEN several THEN '' ELSE t END AS t FROM e) SELECT locale, count(*) FILTER (obsolete AND t <> '') AS kept, count(*) FILTER (obsolete AND t = '') AS gone, count(*) FILTER (NOT obsolete) AS live FROM s GROUP BY locale")
def obsolete_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Obsolete entries with a text turn into comments, those without go."""
    rows = catalogue_queries.entries(spark, sf_dir).withColumn("raw", F.concat(F.lit('#~ msgid "'), "msgid", F.lit('"')))
    out = rewrite.obsolete_kept(rows)
    counts = out.groupBy("locale").agg(F.count_if(C("obsolete") & C("raw").startswith("# OBSOLETE: ")).alias("kept"), F.count_if(~C("obsolete")).alias("live"))
    gone = rows.filter("obsolete").groupBy(C("locale").alias("_l")).agg(F.count("*").alias("all"))
    return counts.join(gone, C("locale") == C("_l"), "left").select("locale", "kept", (F.coalesce("all", F.lit(0)) - C("kept")).alias("gone"), "live")


# --- entries against payloads and corrections --------------------------------------------------


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalogue_queries.entries(spark, sf_dir).filter(C("msgid") != "API")
    return rows.withColumn("flags", F.when(C("is_fuzzy"), F.array(F.lit("fuzzy"), F.lit("c-format"))).otherwise(F.array(F.lit("c-format"))))


@query(f"""WITH {_ENTRIES}, p AS (SELECT *, CASE pos % 6 WHEN 0 THEN 'neu ' || msgid WHEN 1 THEN CASE WHEN several THEN '' ELSE t END END AS new FROM e WHERE locale = 'de_DE' AND msgid <> 'API')
 SELECT pos, coalesce(nullif(new, ''), CASE WHEN several THEN '' ELSE t END) AS msgstr, CASE WHEN fuzzy AND coalesce(new, '') = '' THEN 'fuzzy,c-format' ELSE 'c-format' END AS flags, coalesce(new, '') <> '' AND new <> CASE WHEN several THEN '' ELSE t END AS dirty FROM p""")
def payload_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload for a sixth of a catalogue, and the texts as they are for another sixth: only the first are dirty, all clear the fuzzy flag."""
    rows = _flagged(spark, sf_dir).filter(C("locale") == "de_DE")
    new = F.when(C("pos") % 6 == 0, F.concat(F.lit("neu "), "msgid")).when(C("pos") % 6 == 1, C("msgstr"))
    out = rewrite.imported(rows, rows.select("msgid", new.alias("translation")))
    return out.select("pos", "msgstr", F.array_join("flags", ",").alias("flags"), "dirty")


@query(f"""WITH {_ENTRIES} SELECT pos, CASE WHEN NOT several THEN CASE WHEN pos % 4 = 2 THEN msgid ELSE t END WHEN pos % 4 = 2 THEN msgid || '|' || msgid || 's|' || msgid || 's' ELSE t || CASE WHEN short THEN '' ELSE '|trads ' || msgid END END AS texts FROM e WHERE locale = 'es_ES'""")
def english_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of a catalogue fails a check and falls back to its sources, in three plural forms."""
    rows = catalogue_queries.entries(spark, sf_dir).filter(C("locale") == "es_ES")
    out = rewrite.english_fallback(rows, rows.filter(C("pos") % 4 == 2), F.lit(3))
    return out.select("pos", F.when(C("msgid_plural") == "", C("msgstr")).otherwise(F.array_join(F.transform(F.array_sort(F.map_keys("plurals")), lambda k: F.element_at("plurals", k)), "|")).alias("texts"))


@query(f"""WITH {_ENTRIES}, f AS (SELECT *, pos % 10 = 4 AND locale IN ('fr_FR', 'xx_XX') AS bad, CASE WHEN pos % 10 = 4 AND locale IN ('fr_FR', 'xx_XX') THEN msgid ELSE 'Ok ' || msgid END AS new FROM e WHERE pos % 2 = 0 AND msgid <> 'API'),
 stopped AS (SELECT DISTINCT locale FROM f WHERE bad) SELECT locale, pos, 'refused' AS outcome, 'echo' AS text FROM f WHERE bad UNION ALL SELECT e.locale, e.pos, 'entry', CASE WHEN stopped.locale IS NULL AND f.pos IS NOT NULL THEN f.new ELSE CASE WHEN e.several THEN '' ELSE e.t END END FROM e LEFT JOIN f ON e.pos = f.pos LEFT JOIN stopped ON e.locale = stopped.locale WHERE e.msgid <> 'API'""")
def reviewed_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of half of all entries; a locale with one that the gate refuses keeps its entries."""
    rows = _flagged(spark, sf_dir)
    bad = (C("pos") % 10 == 4) & C("locale").isin("fr_FR", "xx_XX")
    fixes = rows.filter(C("pos") % 2 == 0).select("locale", "msgid", F.when(bad, C("msgid")).otherwise(F.concat(F.lit("Ok "), "msgid")).alias("text"))
    result, problems = rewrite.reviewed(rows, fixes)
    refused = problems.join(rows.select("locale", "msgid", "pos"), ["locale", "msgid"]).select("locale", "pos", F.lit("refused").alias("outcome"), F.array_join("reasons", "|").alias("text"))
    return refused.unionByName(result.select("locale", "pos", F.lit("entry").alias("outcome"), C("msgstr").alias("text")))


# --- names, servers and times ------------------------------------------------------------------


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 IN (0, 1) THEN 'whois.' || s_nationkey || '.example' END AS server, strftime(make_date(2020, 1, 1) + (s_suppkey % 900)::INT, '%Y-%m-%d 00:00+0000') AS stamp, CASE s_suppkey % 3 WHEN 0 THEN 'münchen.' || s_suppkey || '.example' WHEN 1 THEN 'a' || s_suppkey || '.example' ELSE 'xn--' || '.' || s_suppkey END AS shown FROM supplier""")
def registry_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Servers of lookup responses, times as headers write them and domains in display form, for each supplier."""
    k, n = C("s_suppkey"), C("s_nationkey").cast("string")
    response = F.when(k % 4 == 0, F.concat(F.lit("domain: X\nWHOIS: \t WHOIS."), n, F.lit(".Example\nstatus: ok"))).when(k % 4 == 1, F.concat(F.lit("whois:whois."), n, F.lit(".example"))).when(k % 4 == 2, "whois: -\n").otherwise("whois:\nnull")
    name = F.when(k % 3 == 0, F.concat(F.lit("xn--mnchen-3ya."), k.cast("string"), F.lit(".example"))).when(k % 3 == 1, F.concat(F.lit("a"), k.cast("string"), F.lit(".example"))).otherwise(F.concat(F.lit("xn--."), k.cast("string")))
    at = F.date_add(F.lit("2020-01-01").cast("date"), (k % 900).cast("int")).cast("timestamp")
    rows = table(spark, sf_dir, "supplier")
    return rows.select("s_suppkey", T.whois_server(response).alias("server"), catalogue.stamp(at).alias("stamp"), display_domain_udf(name).alias("shown"))


_RULES = [("10.0.0.0/8",), ("10.1.2.0/24",), ("10.1.2.3",), ("*.s7.test",), (".Example.test",), ("host3.s1.test",), ("192.168.0.0/33",), ("0.0.0.0/1",)]


@query("""WITH h AS (SELECT DISTINCT CASE c_custkey % 3 WHEN 0 THEN '10.' || (c_custkey % 4) || '.' || (c_custkey % 5) || '.' || (c_custkey % 250) WHEN 1 THEN 'host' || (c_custkey % 9) || '.s' || (c_custkey % 11) || '.test' ELSE (c_custkey % 300) || '.1.2.3' END AS host FROM customer),
 p AS (SELECT host, regexp_full_match(host, '[0-9.]+') AND split_part(host, '.', 1)::INT < 256 AS ip, CASE WHEN regexp_full_match(host, '[0-9.]+') THEN ((split_part(host, '.', 1)::BIGINT * 256 + split_part(host, '.', 2)::BIGINT) * 256 + split_part(host, '.', 3)::BIGINT) * 256 + split_part(host, '.', 4)::BIGINT END AS a FROM h)
 SELECT host, '10.0.0.0/8' AS rule FROM p WHERE ip AND a // 16777216 = 10 UNION ALL SELECT host, '10.1.2.0/24' FROM p WHERE ip AND a // 256 = 655618 UNION ALL SELECT host, '10.1.2.3' FROM p WHERE host = '10.1.2.3'
 UNION ALL SELECT host, '*.s7.test' FROM p WHERE suffix(host, '.s7.test') UNION ALL SELECT host, 'host3.s1.test' FROM p WHERE host = 'host3.s1.test' UNION ALL SELECT host, '0.0.0.0/1' FROM p WHERE ip AND a < 2147483648""")
def bypass_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts of customers, by address or name, against a bypass list; a rule that is no network matches nothing."""
    k = C("c_custkey")
    part = lambda n: (k % n).cast("string")
    host = F.when(k % 3 == 0, F.concat_ws(".", F.lit("10"), part(4), part(5), part(250))).when(k % 3 == 1, F.concat(F.lit("host"), part(9), F.lit(".s"), part(11), F.lit(".test"))).otherwise(F.concat(part(300), F.lit(".1.2.3")))
    return relational.bypassed(table(spark, sf_dir, "customer").select(host.alias("host")), spark.createDataFrame(_RULES, "rule string"))


# --- source files ----------------------------------------------------------------------------


def _tree(spark: SparkSession, sf_dir: str) -> str:
    """A file for each source of the documents, its texts one below the other."""
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.concat(F.lit("VERSION = '1."), C("doc_id").cast("string"), F.lit("'\n"), "text").alias("text"))
    folder = shared_dir(spark)
    docs.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "text").write.partitionBy("source").text(folder)
    return folder


@query(r"""WITH l AS (SELECT source, doc_id, unnest(string_split('VERSION = ''1.' || doc_id || '''' || chr(10) || text, chr(10))) AS t FROM documents)
 SELECT source, count(*) AS lines, sum(length(t))::BIGINT AS chars, count(*) FILTER (contains(lower(t), 'license')) = 0 AS unmarked, '1.' || min(doc_id) AS version FROM l GROUP BY source""")
def file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole files, whether they are UTF-8, their lines, a marker that some lack, and the version each states first."""
    found = files.texts(files.whole_files(spark, _tree(spark, sf_dir), "part-*"))
    source = F.regexp_extract("path", "source=([^/]*)/[^/]*$", 1)
    lines = files.lines(found.withColumn("text", F.regexp_replace("text", r"\n\z", ""))).groupBy("path").agg(F.count("*").alias("lines"), F.sum(F.length("text")).alias("chars"))
    without = files.without_marker(found.withColumn("text", F.lower("text")), "license").select(C("path").alias("_w"))
    versions = files.versions(found).select(C("path").alias("_v"), "version")
    out = lines.join(without, C("path") == C("_w"), "left").join(versions, C("path") == C("_v"), "left")
    return out.select(source.alias("source"), "lines", "chars", C("_w").isNotNull().alias("unmarked"), "version")
