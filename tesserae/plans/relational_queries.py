"""Queries of the relational, statistical and rewriting operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import plural
from ..functions import text as T
from ..functions.similarity import masked_udf, repaired_udf
from ..operators import registry, relational, rewrite, stats, verify
from ..streaming.checking import windowed_counts
from .pairs import PAIR_DAMAGED, PAIR_DOC, PAIR_PAGE, pair_damaged, pair_doc, pair_page, quoted, table

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


# --- coverage ----------------------------------------------------------------------------

EXCLUSIONS = ["API", "DNS", "URL", "TTL", "OK"]


def _coverage_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against the text before them: every fifth an echo, half of these of a few words, every seventh empty, every eleventh obsolete; every third echo flagged."""
    i = C("pos")
    src = F.when(i % 10 == 0, F.left("src", (i % 30).cast("int"))).otherwise(C("src"))
    rows = pair_doc(spark, sf_dir).select("pos", "locale", src.alias("src"), "dst", (i % 3 == 0).alias("flagged"), (i % 11 == 0).alias("obsolete"))
    return rows.withColumn("dst", F.when(i % 7 == 0, "").when(i % 5 == 0, C("src")).otherwise(C("dst")))


_COVERAGE = rf"""{PAIR_DOC}, s AS (SELECT pos, locale, CASE WHEN pos % 10 = 0 THEN left(src, pos % 30) ELSE src END AS src, dst FROM pair), p AS (SELECT pos, locale, src, CASE WHEN pos % 7 = 0 THEN '' WHEN pos % 5 = 0 THEN src ELSE dst END AS dst, pos % 3 = 0 AS flagged, pos % 11 = 0 AS obsolete FROM s),
 w AS (SELECT *, list_filter(regexp_split_to_array(src, '\s+'), lambda x: x <> '') AS ws, len(regexp_extract_all(src, '[\p{{L}}\p{{N}}_]+')) AS n FROM p),
 k AS (SELECT *, dst <> '' AND dst = src AS echo, NOT obsolete AND NOT (src IN ('API', 'DNS', 'URL', 'TTL', 'OK') OR (len(ws) > 0 AND len(list_filter(ws, lambda x: upper(x) NOT IN ('API', 'DNS', 'URL', 'TTL', 'OK'))) = 0) OR (length(src) <= 5 AND upper(src) = src AND lower(src) <> src)) AS own FROM w),
 c AS (SELECT locale, count(*) FILTER (own) AS total, count(*) FILTER (own AND dst <> '') AS filled, count(*) FILTER (own AND dst <> '' AND NOT echo) AS "real", count(*) FILTER (own AND echo AND flagged) AS fallback, count(*) FILTER (own AND echo AND NOT flagged AND n <= 2) AS identity, count(*) FILTER (obsolete AND src <> '') AS orphaned FROM k GROUP BY locale)"""


@query(f'WITH {_COVERAGE} SELECT *, round(100.0 * "real" / total, 2)::DOUBLE AS pct FROM c')
def coverage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.coverage(_coverage_pairs(spark, sf_dir), EXCLUSIONS, C("flagged"), C("obsolete"))


@query(f'WITH {_COVERAGE}, d AS (SELECT *, round(100.0 * "real" / total, 2) AS pct FROM c) SELECT count(*) AS locales, sum(total)::BIGINT AS total, sum("real")::BIGINT AS "real", floor(sum(total) / count(*))::BIGINT AS average, count(*) FILTER (pct >= 95) AS done FROM d')
def coverage_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.totals(stats.coverage(_coverage_pairs(spark, sf_dir), EXCLUSIONS, C("flagged"), C("obsolete")))


@query("SELECT lang, source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY ROLLUP (lang, source)")
def coverage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


# --- joins -------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def stale_entries_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(C("o_custkey").alias("c_custkey"))
    return relational.stale(table(spark, sf_dir, "customer"), orders, "c_custkey").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def live_entries_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(C("o_custkey").alias("c_custkey"))
    return relational.live(table(spark, sf_dir, "customer"), orders, "c_custkey").select("c_custkey", "c_name")


@query("SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, b.p_name AS p_name, CASE WHEN b.p_partkey IS NULL THEN 'new' WHEN a.p_partkey IS NULL THEN 'obsolete' ELSE 'kept' END AS status FROM (SELECT * FROM part WHERE p_partkey % 3 <> 0) a FULL JOIN (SELECT * FROM part WHERE p_partkey % 5 <> 0) b ON a.p_partkey = b.p_partkey")
def catalog_merge_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return relational.merged(part.filter("p_partkey % 3 <> 0"), part.filter("p_partkey % 5 <> 0"), "p_partkey", "p_name")


def _registries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    k = C("s_suppkey")
    old = rows.filter(k % 4 != 0).select(F.upper("s_name").alias("key"), F.concat(F.lit("http://"), F.when(k % 3 == 0, "old").otherwise("rdap"), F.lit(".test/"), k.cast("string")).alias("url"))
    new = rows.filter(k % 5 != 0).select("s_name", F.concat(F.lit("https://rdap.test/"), k.cast("string")).alias("url"))
    return old, new.withColumnRenamed("s_name", "key")


_DIFF = """o AS (SELECT lower(s_name) AS key, 'https://' || CASE WHEN s_suppkey % 3 = 0 THEN 'old' ELSE 'rdap' END || '.test/' || s_suppkey AS old_value FROM supplier WHERE s_suppkey % 4 <> 0),
 n AS (SELECT lower(s_name) AS key, 'https://rdap.test/' || s_suppkey AS new_value FROM supplier WHERE s_suppkey % 5 <> 0),
 d AS (SELECT coalesce(n.key, o.key) AS key, old_value, new_value, CASE WHEN o.key IS NULL THEN 'added' WHEN n.key IS NULL THEN 'removed' WHEN old_value = new_value THEN 'unchanged' ELSE 'updated' END AS status FROM o FULL JOIN n ON o.key = n.key)"""


@query(f"WITH {_DIFF} SELECT * FROM d")
def registry_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _registries(spark, sf_dir)
    return relational.registry_diff(old, new, "key", "url", T.https_url(C("url")))


@query(f"WITH {_DIFF} SELECT status, count(*) AS n FROM d GROUP BY status")
def registry_diff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _registries(spark, sf_dir)
    return relational.registry_diff(old, new, "key", "url", T.https_url(C("url"))).groupBy("status").agg(F.count("*").alias("n"))


@query("""WITH u AS (SELECT s_suppkey AS k, s_name AS key, s_suppkey % 11 = 0 AS failed, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'w' || s_suppkey % 7 END AS server, s_suppkey % 3 <> 0 AS reachable FROM supplier),
 e AS (SELECT s_name AS k2, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'w' || s_suppkey % 2 END AS old_server, s_suppkey % 2 = 0 AS old_reachable FROM supplier),
 a AS (SELECT key, server, old_server, CASE WHEN failed THEN 'untouched' WHEN server IS NOT NULL AND old_server IS NULL THEN CASE WHEN reachable THEN 'added' ELSE 'skipped' END WHEN server = old_server THEN 'unchanged' WHEN server IS NOT NULL THEN CASE WHEN reachable THEN 'updated' ELSE 'skipped' END WHEN old_server IS NOT NULL THEN CASE WHEN old_reachable THEN 'kept' ELSE 'removed' END ELSE 'none' END AS action FROM u JOIN e ON key = k2)
 SELECT key, CASE WHEN action IN ('added', 'updated') THEN server WHEN action = 'removed' THEN NULL ELSE old_server END AS value, action FROM a""")
def guarded_registry_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, k = table(spark, sf_dir, "supplier"), C("s_suppkey")
    up = rows.select(C("s_name").alias("key"), (k % 11 == 0).alias("failed"), F.when(k % 5 != 0, F.concat(F.lit("w"), (k % 7).cast("string"))).alias("server"), (k % 3 != 0).alias("reachable"))
    old = rows.select(C("s_name").alias("key"), F.when(k % 4 != 0, F.concat(F.lit("w"), (k % 2).cast("string"))).alias("old_server"), (k % 2 == 0).alias("old_reachable"))
    return relational.guarded_sync(up, old)


@query("SELECT a.doc_id, CASE WHEN a.doc_id % 3 = 0 THEN CASE WHEN b.text IS NOT NULL AND b.text <> '' THEN md5(b.text) ELSE md5('') END ELSE md5(a.text) END AS md5, CASE WHEN a.doc_id % 3 = 0 AND b.text <> '' THEN 'auto-english-fallback' END AS flag FROM documents a LEFT JOIN (SELECT * FROM documents WHERE lang = 'en') b ON a.doc_id = b.doc_id")
def fallback_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    holed = docs.select("doc_id", F.when(C("doc_id") % 3 == 0, "").otherwise(C("text")).alias("text"))
    return relational.filled(holed, docs.filter("lang = 'en'"), "doc_id", "text").select("doc_id", F.md5("text").alias("md5"), "flag")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'first' WHEN o_orderkey % 3 = 0 THEN 'second' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def payload_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    first = orders.filter("o_orderkey % 2 = 0").withColumn("o_orderpriority", F.lit("first"))
    second = orders.filter("o_orderkey % 3 = 0").withColumn("o_orderpriority", F.lit("second"))
    return relational.prioritised(orders, first, second, "o_orderkey", "o_orderpriority")


@query("SELECT r_name, count(*) AS customers, max(c_custkey) AS last_key FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey WHERE c_mktsegment = 'BUILDING' GROUP BY r_name")
def perm_join_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("region", "nation", "customer")}
    rows = t["customer"].filter("c_mktsegment = 'BUILDING'").join(t["nation"], C("c_nationkey") == C("n_nationkey")).join(t["region"], C("n_regionkey") == C("r_regionkey"))
    return rows.groupBy("r_name").agg(F.count("*").alias("customers"), F.max("c_custkey").alias("last_key"))


@query("WITH c AS (SELECT l_orderkey, max(l_shipdate) AS built FROM lineitem WHERE l_orderkey % 7 <> 0 GROUP BY l_orderkey) SELECT o_orderkey, CASE WHEN built IS NULL THEN 'missing' WHEN o_orderdate > built THEN 'outdated' ELSE 'fresh' END AS state FROM orders LEFT JOIN c ON o_orderkey = l_orderkey")
def compiled_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", C("o_orderdate").alias("at"))
    built = table(spark, sf_dir, "lineitem").filter("l_orderkey % 7 <> 0").groupBy(C("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("at"))
    return relational.staleness(orders, built, "o_orderkey", "at")


# --- winners, unions, places ---------------------------------------------------------------

_RANKED = """p AS (SELECT l_orderkey, l_returnflag AS family, l_linestatus || l_linenumber AS t, CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 0 END AS r FROM lineitem),
 w AS (SELECT *, max(r) OVER (PARTITION BY l_orderkey) AS top FROM p)"""


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", F.concat("l_linestatus", C("l_linenumber").cast("string")).alias("t"))
    return relational.ranked_winners(rows, "l_orderkey", "l_returnflag", "t", ["N", "R"])


@query(f"WITH {_RANKED} SELECT l_orderkey, min(t) FILTER (r = top) AS t, count(*) FILTER (r < top) AS n_overridden, count(DISTINCT t) FILTER (r = top) > 1 AS conflict FROM w GROUP BY l_orderkey")
def ranked_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir)


@query(f"WITH {_RANKED}, g AS (SELECT l_orderkey, count(DISTINCT t) FILTER (r = top) > 1 AS conflict FROM w GROUP BY l_orderkey) SELECT conflict, count(*) AS n FROM g GROUP BY conflict")
def override_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).groupBy("conflict").agg(F.count("*").alias("n"))


@query("SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey")
def last_wins_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.last_wins(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


@query("WITH u AS (SELECT 0 AS source_rank, n_name AS term, 'nation' AS grp FROM nation UNION ALL SELECT 1, r_name, 'region' FROM region UNION ALL SELECT 2, p_brand, 'brand' FROM part) SELECT term, min(source_rank)::BIGINT AS source_rank, arg_min(grp, source_rank) AS grp FROM u GROUP BY term")
def first_wins_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [table(spark, sf_dir, t).select(C(c).alias("term"), F.lit(g).alias("grp")) for t, c, g in (("nation", "n_name", "nation"), ("region", "r_name", "region"), ("part", "p_brand", "brand"))]
    return relational.first_wins(sources, "term").withColumn("source_rank", C("source_rank").cast("long"))


@query("SELECT md5(text) AS md5, min(doc_id) AS first_pos, count(*) AS n, string_agg(doc_id::VARCHAR, ' ' ORDER BY doc_id) AS locations FROM documents GROUP BY text")
def dedup_merge_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(C("doc_id").alias("at"), C("doc_id").alias("place"), "text")
    return relational.merged_locations(rows, "text", "place", "at").select(F.md5("text").alias("md5"), "first_pos", "n", "locations")


_SPANS = "s AS (SELECT source, doc_id, 1 + coalesce(sum(length(text) - length(replace(text, chr(10), '')) + 1) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line_start, length(text) - length(replace(text, chr(10), '')) AS feeds FROM documents)"


@query(f"WITH {_SPANS} SELECT source, doc_id, line_start, line_start + feeds AS line_end FROM s")
def line_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.line_spans(table(spark, sf_dir, "documents"), "source", "doc_id", "text").select("source", "doc_id", "line_start", "line_end")


@query(f"WITH {_SPANS}, q AS (SELECT DISTINCT source, doc_id * 3 % 200 + 1 AS line FROM documents) SELECT q.source, q.line, (SELECT arg_max(doc_id, line_start) FROM s WHERE s.source = q.source AND s.line_start <= q.line) AS doc_id FROM q")
def line_owner_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    spans = relational.line_spans(docs, "source", "doc_id", "text").select("source", "doc_id", "line_start")
    lines = docs.select("source", (C("doc_id") * 3 % 200 + 1).alias("line")).distinct()
    return relational.line_owners(lines, spans, "source", "line").select("source", "line", "doc_id")


@query(f"WITH {PAIR_PAGE}, b AS (SELECT *, row_number() OVER (PARTITION BY locale ORDER BY pos) AS k FROM pair WHERE dst = '' OR dst = src) SELECT locale, pos FROM b WHERE k <= 10")
def untranslated_bucket_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pair_page(spark, sf_dir).filter(stats.is_untranslated(C("src"), C("dst"), C("locale")))
    return relational.kept_first(rows, "locale", "pos", 10).select("locale", "pos")


# --- rewriting -----------------------------------------------------------------------------

#: Our own rules for the standard tables.
RULES = [
    rewrite.Rule("en", r"the ([a-z])", r"\1", include="license"),
    rewrite.Rule("en", "tion", "cion", exclude="[0-9]"),
    rewrite.Rule("de", "ß", "ss"),
    rewrite.Rule("fr", "eau(x?)", r"o\1"),
    rewrite.Rule("es", "ción", "cion"),
]


@query(rf"""WITH {PAIR_DOC}, a AS (SELECT pos, locale, dst, CASE WHEN locale = 'en' AND regexp_matches(src, '(?i)license') THEN regexp_replace(dst, 'the ([a-z])', '\1', 'g') WHEN locale = 'de' THEN replace(dst, 'ß', 'ss') WHEN locale = 'fr' THEN regexp_replace(dst, 'eau(x?)', 'o\1', 'g') WHEN locale = 'es' THEN replace(dst, 'ción', 'cion') ELSE dst END AS t, src FROM pair),
 b AS (SELECT *, CASE WHEN dst = src THEN dst WHEN locale = 'en' AND NOT regexp_matches(src, '[0-9]') THEN replace(t, 'tion', 'cion') ELSE t END AS u FROM a) SELECT pos, locale, md5(u) AS md5 FROM b WHERE u <> dst AND dst <> src""")
def rule_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rewrite.rewritten(pair_doc(spark, sf_dir), RULES).filter("changed").select("pos", "locale", F.md5("new_dst").alias("md5"))


_TOKENS = r"regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+')"


@query(rf"""WITH t AS (SELECT doc_id, text, {_TOKENS} AS t FROM documents), n AS (SELECT doc_id, text, array_to_string(list_filter(list_transform(range(1, len(t) + 1), lambda i: CASE
 WHEN i > 2 AND t[i - 1] = ' ' AND t[i] = t[i - 2] AND regexp_full_match(t[i], '\p{{L}}{{3,}}') THEN NULL WHEN i > 1 AND t[i] = ' ' AND t[i + 1] = t[i - 1] AND regexp_full_match(t[i + 1], '\p{{L}}{{3,}}') THEN NULL ELSE t[i] END), lambda x: x IS NOT NULL), '') AS new FROM t)
 SELECT doc_id, md5(new) AS md5 FROM n WHERE new <> text""")
def collapse_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("new", T.collapse_repeats(C("text")))
    return docs.filter(C("new") != C("text")).select("doc_id", F.md5("new").alias("md5"))


@query(rf"WITH {PAIR_DAMAGED} SELECT pos, md5(dst || regexp_extract(src, '(\s*)$', 1)) AS md5 FROM pair WHERE regexp_matches(src, '\s$') AND NOT regexp_matches(dst, '\s$')")
def restore_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pair_damaged(spark, sf_dir).withColumn("new", rewrite.with_trailing_space(C("src"), C("dst")))
    return rows.filter(C("new") != C("dst")).select("pos", F.md5("new").alias("md5"))


@query(rf"WITH {PAIR_DAMAGED}, n AS (SELECT pos, dst, CASE WHEN regexp_matches(src, '(%(?:[0-9]+\$)?[sdfucxXob])Z+') THEN dst ELSE regexp_replace(dst, '(%(?:[0-9]+\$)?[sdfucxXob])Z+', '\1', 'g') END AS new FROM pair) SELECT pos, md5(new) AS md5 FROM n WHERE new <> dst")
def strip_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pair_damaged(spark, sf_dir).withColumn("new", rewrite.without_leaks(C("src"), C("dst")))
    return rows.filter(C("new") != C("dst")).select("pos", F.md5("new").alias("md5"))


@query(f"WITH {PAIR_DAMAGED} SELECT pos, md5(replace(dst, 'user name id', 'user_name_id')) AS md5 FROM pair WHERE contains(dst, 'user name id')")
def restore_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pair_damaged(spark, sf_dir).filter(F.exists(T.identifiers(C("src")), lambda x: ~F.contains(C("dst"), x)))
    return rows.withColumn("new", rewrite.restored_identifiers(C("src"), C("dst"))).filter(C("new") != C("dst")).select("pos", F.md5("new").alias("md5"))


@query("SELECT doc_id, md5('Copyright 2019-2026 ' || text) AS md5 FROM documents")
def year_roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(rewrite.year_rolled(F.concat(F.lit("Copyright 2019-2025 "), "text"), 2026)).alias("md5"))


@query(r"SELECT conv_id, turn, md5(regexp_replace(text || chr(10) || '  ' || chr(9) || chr(10) || 'x', '(?m)^[ \t]+$', '', 'g')) AS md5 FROM conversations")
def blank_line_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("text", F.lit("\n  \t\nx"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(rewrite.blank_lines_trimmed(text)).alias("md5"))


@query(f"WITH {PAIR_DAMAGED} SELECT pos, true AS same FROM pair")
def sentinel_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pair_damaged(spark, sf_dir)
    return rows.select("pos", (repaired_udf(C("src"), masked_udf(C("src"))) == C("src")).alias("same"))


# --- plural rules --------------------------------------------------------------------------

#: Well-known rules of plural forms.
PLURALS = [
    ("en", "n != 1"), ("fr", "n > 1"), ("ja", "0"),
    ("ru", "n%10==1 && n%100!=11 ? 0 : n%10>=2 && n%10<=4 && (n%100<10 || n%100>=20) ? 1 : 2"),
    ("pl", "n==1 ? 0 : n%10>=2 && n%10<=4 && (n%100<10 || n%100>=20) ? 1 : 2"),
    ("ar", "n==0 ? 0 : n==1 ? 1 : n==2 ? 2 : n%100>=3 && n%100<=10 ? 3 : n%100>=11 ? 4 : 5"),
]


_NUMBERS = "r AS (SELECT o_orderkey % 1000 AS n FROM orders)"


@query(f"""WITH {_NUMBERS}, f AS (SELECT 'en' AS locale, (n <> 1)::BIGINT AS form FROM r UNION ALL SELECT 'fr', (n > 1)::BIGINT FROM r UNION ALL SELECT 'ja', 0 FROM r
 UNION ALL SELECT 'ru', CASE WHEN n % 10 = 1 AND n % 100 <> 11 THEN 0 WHEN n % 10 BETWEEN 2 AND 4 AND n % 100 NOT BETWEEN 10 AND 19 THEN 1 ELSE 2 END FROM r
 UNION ALL SELECT 'pl', CASE WHEN n = 1 THEN 0 WHEN n % 10 BETWEEN 2 AND 4 AND n % 100 NOT BETWEEN 10 AND 19 THEN 1 ELSE 2 END FROM r
 UNION ALL SELECT 'ar', CASE WHEN n < 3 THEN n WHEN n % 100 BETWEEN 3 AND 10 THEN 3 WHEN n % 100 >= 11 THEN 4 ELSE 5 END FROM r) SELECT locale, form, count(*) AS n FROM f GROUP BY ALL""")
def plural_rule_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plural form of every order's number in six languages, counted."""
    numbers = table(spark, sf_dir, "orders").select((C("o_orderkey") % 1000).alias("n"))
    return plural.evaluated(numbers, PLURALS).groupBy("locale", C("form").cast("long").alias("form")).agg(F.count("*").alias("n"))


@query(f"""WITH {_NUMBERS} SELECT 'ru' AS a, 'ru2' AS b, 0::BIGINT AS differing UNION ALL SELECT 'en', 'fr', (SELECT count(*) FILTER (n = 0) FROM r) UNION ALL SELECT 'pl', 'ru', (SELECT count(*) FILTER (n <> 1 AND n % 10 = 1 AND n % 100 <> 11) FROM r)""")
def plural_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For how many orders' numbers two rules give different forms."""
    ru2 = "n%10==1 && n%100!=11 ? 0 : n%10>=2 && n%10<=4 && (n%100<12 || n%100>14) ? 1 : 2"
    n = table(spark, sf_dir, "orders").select((C("o_orderkey") % 1000).alias("n"))
    rules = dict(PLURALS)
    pairs = [("ru", "ru2", rules["ru"], ru2), ("en", "fr", rules["en"], rules["fr"]), ("pl", "ru", rules["pl"], rules["ru"])]
    return n.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), (plural.form(x) != plural.form(y)).cast("long").alias("d")) for a, b, x, y in pairs])).alias("r")).groupBy("r.a", "r.b").agg(F.sum("r.d").alias("differing"))


# --- registries, extraction, glossary, logs --------------------------------------------------


@query("SELECT DISTINCT name FROM (SELECT unnest(regexp_extract_all(html, '<a href=\"/([^\"]*)\"', 1)) AS name FROM pages)")
def tld_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.links(table(spark, sf_dir, "pages"), "html", '<a href="/([^"]*)"')


@query("SELECT event_type, json_extract_string(props, '$.k')::BIGINT AS k, count(*) AS n FROM events GROUP BY ALL")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k bigint")["k"].alias("k")).groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query("SELECT lower(n_name) AS key, 'https://rdap.' || lower(r_name) || '/' AS url FROM nation JOIN region ON n_regionkey = r_regionkey")
def nested_services_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), C("n_regionkey") == C("r_regionkey"))
    service = rows.groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("names")).select(F.array("names", F.array(F.concat(F.lit("http://rdap."), F.lower("r_name"), F.lit("/")))).alias("s"))
    body = service.agg(F.to_json(F.struct(F.collect_list("s").alias("services"))).alias("body"))
    return registry.services(body, "body")


@query(r"""WITH l AS (SELECT page_id, unnest(string_split(html, chr(10))) AS line FROM pages), t AS (SELECT page_id, unnest(regexp_extract_all(line, '<h1>([^<]*)</h1>', 1)) AS msgid FROM l) SELECT md5(regexp_replace(regexp_replace(msgid, '^\s+', ''), '\s+$', '')) AS md5, page_id FROM t WHERE regexp_replace(msgid, '^\s+', '') <> '' AND NOT contains(msgid, chr(39))""")
def extract_strings_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of pages as template strings, then extracted line by line as from any template."""
    heads = table(spark, sf_dir, "pages").select("page_id", F.explode(F.split("html", "\n")).alias("text")).withColumn("head", F.explode(T.find(C("text"), "<h1>([^<]*)</h1>", 1)))
    lines = heads.filter(~F.contains("head", F.lit("'"))).select("page_id", F.lit(1).alias("line"), F.concat(F.lit("<h1>{% trans '"), "head", F.lit("' %}</h1>")).alias("text"))
    return registry.template_strings(lines, "page_id", "line", "text").select(F.md5("msgid").alias("md5"), "page_id")


_TERMS = r"SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS term FROM benchmark"


@query(rf"WITH t AS ({_TERMS}), w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+'))) AS w FROM documents) SELECT term, count(*) AS n FROM t JOIN w ON term = w GROUP BY term")
def glossary_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = table(spark, sf_dir, "benchmark").select(F.explode(T.find(C("text"), r"[\p{L}\p{N}]+")).alias("term")).distinct()
    return registry.glossary_terms(terms, table(spark, sf_dir, "documents"), "term", "text")


@query("SELECT o_orderkey, datediff('day', o_orderdate::DATE, DATE '1998-08-02') AS age, CASE WHEN age < 30 THEN 'fresh' WHEN age < 90 THEN 'aging' ELSE 'stale' END AS state FROM orders")
def freshness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = verify.fresh(table(spark, sf_dir, "orders"), "o_orderdate", F.lit("1998-08-02").cast("date"), 30, 90)
    return rows.select("o_orderkey", C("age").cast("long").alias("age"), "state")


@query("""WITH l AS (SELECT event_type AS path, event_id AS line, CASE WHEN event_id % 2 = 0 THEN 'passed' ELSE 'failed' END AS kind, (event_id % 50) AS k, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS r FROM events)
 SELECT path, coalesce(sum(k) FILTER (kind = 'passed'), 0)::BIGINT AS passed, coalesce(sum(k) FILTER (kind = 'failed'), 0)::BIGINT AS failed, 0::BIGINT AS skipped, 0::BIGINT AS flaky FROM l WHERE r <= 40 GROUP BY path""")
def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    text = F.concat(F.lit("\x1b[32m  "), (C("event_id") % 50).cast("string"), F.when(C("event_id") % 2 == 0, " passed").otherwise(" failed"), F.lit("\x1b[0m (3s)"))
    lines = events.select(C("event_type").alias("path"), C("event_id").alias("line"), text.alias("text"))
    return verify.log_totals(verify.tail(lines, "path", "line", 40), "path", "text")


_EXPECTED = [("regions", "region", "=", 5), ("nations", "nation", "=", 25), ("customers", "customer", ">=", 100), ("no_orders", "orders", "=", 0)]


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS actual, {k}::BIGINT AS expected, CASE WHEN count(*) {op} {k} THEN 'pass' ELSE 'fail' END AS outcome FROM {t}" for n, t, op, k in _EXPECTED))
def expectation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.expectations([(n, table(spark, sf_dir, t), op, k) for n, t, op, k in _EXPECTED])


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_counts(table(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))
