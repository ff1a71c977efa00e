"""Queries of longer work: batches that resume, rewrites that are verified, rules and documents given as data, templates, gates."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, inspection, publishing, relational, reports, resumable, rule_tables
from ..sources import json_documents, php, pot
from ..sources.shared import shared_dir
from .check_queries import ROW_SQL
from .pairs import PAIR_DAMAGED, PAIR_DOC, pair_damaged, pair_doc, table

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


# --- batches and versions --------------------------------------------------------------------


@query("SELECT doc_id, md5('done ' || text) AS done, 1::BIGINT AS n FROM documents")
def resumable_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents worked off by a run that ends after two of five batches, and one with other batches that takes up the rest."""
    docs = table(spark, sf_dir, "documents")
    ledger = resumable.Ledger(spark, shared_dir(spark), "doc_id long, done string")
    work = lambda part: part.select("doc_id", F.md5(F.concat(F.lit("done "), "text")).alias("done"))
    resumable.resumed(docs, ledger, "doc_id", work, batches=5, most=2)
    resumable.resumed(docs, ledger, "doc_id", work, batches=3)
    return ledger.rows().groupBy("doc_id", "done").agg(F.count("*").alias("n"))


_BLANK = r"len(list_filter(string_split({t}, chr(10)), lambda x: regexp_full_match(x, '[ \t]+')))"


@query(rf"""WITH f AS (SELECT doc_id AS path, CASE WHEN doc_id % 3 = 0 THEN text ELSE replace(text, chr(10), chr(10) || ' ' || chr(9) || chr(10)) END AS old FROM documents),
 n AS (SELECT *, {_BLANK.format(t='old')} AS before, regexp_replace(CASE WHEN path % 5 = 0 THEN replace(old, chr(9), '') ELSE old END, '(?m)^[ \t]*\t[ \t]*$', '', 'g') AS new FROM f),
 c AS (SELECT *, {_BLANK.format(t='new')} AS after FROM n)
 SELECT path, CASE WHEN before = 0 THEN 'clean' WHEN after = 0 THEN 'fixed' ELSE 'restored' END AS outcome, md5(CASE WHEN before > 0 AND after = 0 THEN new ELSE old END) AS md5 FROM c""")
def verified_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of white space emptied in all documents; for every fifth the rewrite leaves some, so that it keeps its old text."""
    text = F.when(C("doc_id") % 3 == 0, C("text")).otherwise(F.replace(C("text"), F.lit("\n"), F.lit("\n \t\n")))
    store = publishing.Store(spark, shared_dir(spark))
    store.publish(store.stage(table(spark, sf_dir, "documents").select(C("doc_id").alias("path"), text.alias("content"))))
    fix = lambda c: F.regexp_replace(F.when(C("path") % 5 == 0, F.replace(c, F.lit("\t"), F.lit(""))).otherwise(c), r"(?m)^[ \t]*\t[ \t]*$", "")
    report = publishing.rewritten(store, "content", fix, lambda c: F.size(F.filter(F.split(c, "\n"), lambda x: x.rlike(r"^[ \t]+$"))))
    own = report.select(C("path").alias("_p"), "outcome")
    return store.read().join(own, C("path") == C("_p"), "left").select("path", F.coalesce("outcome", F.lit("clean")).alias("outcome"), F.md5("content").alias("md5"))


_MAPS = """o AS (SELECT lower(s_name) AS key, s_acctbal::VARCHAR AS v, s_suppkey AS k FROM supplier WHERE s_suppkey % 7 <> 0), n AS (SELECT lower(s_name) AS key, CASE WHEN s_suppkey % 3 = 0 THEN 'new' ELSE s_acctbal::VARCHAR END AS v FROM supplier WHERE s_suppkey % 5 <> 0)"""


@query(f"WITH {_MAPS} SELECT CASE WHEN o.key IS NULL THEN 'added' WHEN n.key IS NULL THEN 'removed' ELSE 'updated' END AS status, count(*) AS n, 2::BIGINT AS versions FROM o FULL JOIN n ON o.key = n.key WHERE o.v IS DISTINCT FROM n.v GROUP BY 1")
def registry_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map written once, tried in a dry run, synchronised with another and then with the same again: two versions in all."""
    k, name, held = C("s_suppkey"), C("s_name"), C("s_acctbal").cast("string")
    rows = table(spark, sf_dir, "supplier")
    old = rows.filter(k % 7 != 0).select(name.alias("key"), held.alias("value"))
    new = rows.filter(k % 5 != 0).select(F.upper(name).alias("key"), F.when(k % 3 == 0, "new").otherwise(held).alias("value"))
    store = publishing.Store(spark, shared_dir(spark))
    publishing.synchronised(store, old, "key", "value")
    publishing.synchronised(store, new, "key", "value", dry_run=True)
    diff = publishing.synchronised(store, new, "key", "value")
    publishing.synchronised(store, new, "key", "value")
    return diff.groupBy("status").agg(F.count("*").alias("n")).withColumn("versions", F.lit(len(store.published())).cast("long"))


@query("""WITH b AS (SELECT doc_id AS k, text AS v, lang AS o FROM documents WHERE doc_id % 31 <> 0), a AS (SELECT doc_id AS k, CASE WHEN doc_id % 6 = 0 THEN text || 'x' ELSE text END AS v, CASE WHEN doc_id % 13 = 0 THEN 'zz' ELSE lang END AS o FROM documents WHERE doc_id % 37 <> 0),
 j AS (SELECT coalesce(a.k, b.k) AS doc_id, a.k AS ak, b.k AS bk, a.v IS DISTINCT FROM b.v AS changed, a.o IS DISTINCT FROM b.o AS spilled FROM a FULL JOIN b ON a.k = b.k)
 SELECT doc_id, CASE WHEN ak IS NULL THEN 'lost' WHEN bk IS NULL THEN 'new' WHEN changed AND doc_id % 4 <> 0 THEN 'unexpected' WHEN NOT changed AND doc_id % 4 = 0 THEN 'missed' END AS problem FROM j WHERE problem IS NOT NULL UNION ALL SELECT doc_id, 'spilled' FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND spilled""")
def change_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rewrite of every sixth document held against a plan for every fourth."""
    i, docs = C("doc_id"), table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    after = docs.filter(i % 37 != 0).select("doc_id", F.when(i % 6 == 0, F.concat("text", F.lit("x"))).otherwise(C("text")).alias("text"), F.when(i % 13 == 0, "zz").otherwise(C("lang")).alias("lang"))
    return relational.audited_changes(docs.filter(i % 31 != 0), after, docs.filter(i % 4 == 0), "doc_id", "text", ["lang"])


_REPORTED = ["placeholder", "tags", "tokens", "boilerplate", "rrtype", "truncation"]
_FOUND = " UNION ALL ".join(f"SELECT pos, locale, '{n}' AS cls, {str(checks.ROW_CHECKS[n].hard).lower()} AS hard, src, dst FROM pair WHERE {ROW_SQL[n]}" for n in _REPORTED)


@query(f"""WITH {PAIR_DAMAGED}, f AS ({_FOUND}), r AS (SELECT *, row_number() OVER (PARTITION BY cls, locale ORDER BY pos) AS place, count(*) OVER (PARTITION BY cls, locale) AS of FROM f)
 SELECT cls, locale, pos, place, of, md5(left(src, 88)) AS src, md5(left(dst, 88)) AS dst FROM r WHERE place <= 3""")
def finding_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three findings of each class and locale: the report's own limit."""
    found = reports.examples(checks.findings(pair_damaged(spark, sf_dir), _REPORTED), ["cls", "locale"], "pos", 3)
    return found.select("cls", "locale", "pos", "place", "of", F.md5("src").alias("src"), F.md5("dst").alias("dst"))


@query(f"""WITH {PAIR_DAMAGED}, f AS ({_FOUND}), c AS (SELECT cls, hard, count(*) AS n FROM f GROUP BY ALL) SELECT cls, '    ' || rpad(cls, 20, ' ') || ' ' || lpad(n::VARCHAR, greatest(5, length(n::VARCHAR))::INT, ' ') || CASE WHEN hard THEN '' ELSE '  (soft)' END AS line FROM c""")
def finding_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.class_totals(checks.findings(pair_damaged(spark, sf_dir), _REPORTED)).select("cls", "line")


# --- rules as data ---------------------------------------------------------------------------

#: A file of mined rules, with a guarded one, one whose replacement has a group and a dollar sign, and problems for a reader.
MINED = {
    "per_locale": {
        "fr": {
            "rules": [
                {"pattern": "(?i)le ", "replace": "la "},
                {"pattern": "la ([a-z]+)", "replace": "$\\1"},
                {"pattern": "un", "replace": "une", "guard": {"include": "THE", "exclude": None}},
            ],
            "review_only": [{"wrong": "aile", "right": "elle", "source_term": "she", "why_not_mechanical": "both are words"}],
        },
        "de": {"rules": [{"pattern": "den", "replace": "dem", "guard": {"include": None, "exclude": "sch"}}], "review_only": [{"wrong": "teer", "right": "Teer", "source_term": "tar", "why_not_mechanical": "a name"}]},
    }
}
CURATED = [("fr", "curated", 0, "et", "&", None, None), ("es", "curated", 0, "(los|las) ([a-z])", "\\2 \\1", None, None)]

_ECHO = r"regexp_replace(dst, '^\s+|\s+$', '', 'g') = regexp_replace(src, '^\s+|\s+$', '', 'g')"
_FR = "regexp_replace(regexp_replace(regexp_replace(dst, 'et', '&', 'g'), '(?i)le ', 'la ', 'g'), 'la ([a-z]+)', '$\\1', 'g')"


@query(rf"""WITH {PAIR_DOC}, n AS (SELECT *, CASE WHEN {_ECHO} THEN dst WHEN locale = 'fr' THEN CASE WHEN regexp_matches(src, '(?i)THE') THEN regexp_replace({_FR}, 'un', 'une', 'g') ELSE {_FR} END
 WHEN locale = 'es' THEN regexp_replace(dst, '(los|las) ([a-z])', '\2 \1', 'g') WHEN locale = 'de' AND NOT regexp_matches(src, '(?i)sch') THEN regexp_replace(dst, 'den', 'dem', 'g') ELSE dst END AS new FROM pair)
 SELECT pos, locale, md5(new) AS md5 FROM n WHERE new <> dst""")
def rule_table_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated rules of a table, then mined ones of a JSON document, over whole documents."""
    mined = rule_tables.mined_rules(spark.createDataFrame([(json.dumps(MINED),)], "text string"))
    rules = rule_tables.in_order(spark.createDataFrame(CURATED, rule_tables.RULES), mined)
    return rule_tables.corrected(pair_doc(spark, sf_dir), rules).filter("changed").select("pos", "locale", F.md5("new_dst").alias("md5"))


@query("""WITH r AS (SELECT 'fr' AS locale, 'aile' AS wrong, 'elle' AS "right" UNION ALL SELECT 'de', 'teer', 'Teer') SELECT locale, wrong, "right", count(doc_id) AS n FROM r LEFT JOIN documents d ON d.lang = r.locale AND contains(d.text, wrong) GROUP BY ALL""")
def review_only_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems left to a reader, with the number of documents that have them."""
    review = rule_tables.review_only(spark.createDataFrame([(json.dumps(MINED),)], "text string"))
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    met = F.broadcast(review).join(docs, C("locale") == C("lang")).filter(F.contains("text", "wrong")).groupBy(C("locale").alias("_l"), C("wrong").alias("_w")).agg(F.count("*").alias("n"))
    return review.join(met, (C("locale") == C("_l")) & (C("wrong") == C("_w")), "left").select("locale", "wrong", "right", F.coalesce("n", F.lit(0)).alias("n"))


# --- documents of unknown shape --------------------------------------------------------------

_BROKEN = "CASE event_id % 11 WHEN 3 THEN '{{' || props WHEN 5 THEN '[' || props || ']' WHEN 7 THEN '{{\"k\": \"' || event_id || '\"}}' WHEN 9 THEN '{{\"j\": 1}}' WHEN 10 THEN '{{\"k\": 1, \"tags\": {{}}}}' ELSE props END".replace("{{", "{").replace("}}", "}")


def _broken_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("text", F.expr(_BROKEN))


@query(f"""WITH t AS (SELECT event_type, {_BROKEN} AS t FROM events), f AS (SELECT event_type, CASE WHEN NOT json_valid(t) THEN 'not JSON' WHEN json_type(t) <> 'OBJECT' THEN '$: ' || lower(json_type(t))
 WHEN json_type(t, '$.k') IS NULL THEN '$.k: absent' WHEN json_type(t, '$.k') = 'VARCHAR' THEN '$.k: string' WHEN json_type(t, '$.tags') = 'OBJECT' THEN '$.tags: object' END AS fault FROM t)
 SELECT event_type, fault, count(*) AS n FROM f WHERE fault IS NOT NULL GROUP BY ALL""")
def json_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = json_documents.faults(_broken_props(spark, sf_dir), "text", {"$": "object", "$.k": "number", "$.tags": "array?"})
    return rows.groupBy("event_type", "fault").agg(F.count("*").alias("n"))


@query("""SELECT n_name AS term, lower(r_name) AS locale, n_name || '|' || lower(n_name) AS renderings FROM nation JOIN region ON n_regionkey = r_regionkey""")
def agreed_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of a JSON document for each region, read back through its shape."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), C("n_regionkey") == C("r_regionkey"))
    forms = F.create_map(F.lower("r_name"), F.array("n_name", F.lower("n_name")))
    document = rows.groupBy("r_name").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", forms)))).alias("body"))
    text = F.concat(F.lit('{"_meta": {"purpose": "x"},'), F.substr("body", F.lit(2)))
    return json_documents.agreed_terms(document.select(text.alias("text"))).select("term", "locale", F.array_join("renderings", "|").alias("renderings"))


# --- sources and templates -------------------------------------------------------------------


@query("""WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS k, unnest(string_split(text, chr(10))) AS t FROM documents)
 SELECT doc_id::VARCHAR AS path, md5(t || ' tail' || chr(10) || '$') AS msgid, CASE WHEN k % 2 = 0 THEN 'many' END AS msgid_plural, (3 * k - 1)::INT AS line FROM l""")
def php_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document in a call over three lines of PHP, with comments and escapes between, found again."""

    def call(line, k):
        escaped = F.regexp_replace(line, r"([\\'])", r"\\$1")
        name = F.when(k % 2 == 1, "ngettext").otherwise("_")
        more = F.when(k % 2 == 1, ", 'many', $n").otherwise("")
        return F.concat(F.lit("$a = "), name, F.lit("( // _('no')\n  '"), escaped, F.lit("' /* _('no') */\n  . \" tail\\n\\$\""), more, F.lit(") . __('no');\n"))

    body = F.array_join(F.transform(F.split("text", "\n"), call), "")
    files = table(spark, sf_dir, "documents").select(C("doc_id").alias("path"), F.concat(F.lit("<?php\n"), body, F.lit("?>\n_('no')\n")).alias("text"))
    return php.translated_strings(files).select("path", F.md5("msgid").alias("msgid"), "msgid_plural", "line")


@query("""WITH r AS (SELECT 0 AS rank, source AS path, doc_id AS line, unnest(string_split(text, chr(10))) AS msgid FROM documents UNION ALL SELECT 1, 'part', p_partkey, p_name || chr(10) || '"' || chr(92) || p_name || chr(9) FROM part),
 d AS (SELECT DISTINCT * FROM r WHERE msgid <> ''), g AS (SELECT msgid, min(struct_pack(rank := rank, path := path, line := line)) AS f, count(*) AS n FROM d GROUP BY msgid)
 SELECT md5(msgid) AS msgid, f.path || ':' || f.line AS first, n FROM g""")
def template_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents and names of parts as a template, written in parts, read back: each text with its places."""
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("msgid"), C("source").alias("path"), C("doc_id").alias("line"))
    names = table(spark, sf_dir, "part").select(F.concat("p_name", F.lit('\n"\\'), "p_name", F.lit("\t")).alias("msgid"), F.lit("part").alias("path"), C("p_partkey").alias("line"))
    folder = shared_dir(spark)
    pot.write_template(pot.template(lines, names), folder, pot.license_head("Corpus", 2026, "its authors"), [("Language", "en_EN")])
    return pot.read_template(spark, folder).filter(~C("is_header")).select(F.md5("msgid").alias("msgid"), F.get("locations", 0).alias("first"), F.size("locations").cast("long").alias("n"))


# --- what there is, and what may go out --------------------------------------------------------

TABLES = ["region", "nation", "customer", "orders", "events", "documents"]
EXPECTED = [
    ("region", None, None, True), ("nation", "n_name", "string", True), ("nation", "n_name", "double", False), ("customer", "c_mfa", None, False), ("orders", "o_orderkey", "bigint", True),
    ("user_groups", None, None, False), ("user_groups", "id", None, False), ("events", "props", "bigint", True), ("documents", None, None, False), ("documents", "text", "string", True), ("zones", "id", None, True),
]


def _values(rows: list[tuple]) -> str:
    show = lambda v: "NULL::VARCHAR" if v is None else str(v).upper() if isinstance(v, bool) else f"'{v}'"
    return ", ".join("(" + ", ".join(map(show, r)) + ")" for r in rows)


@query(f"""WITH k AS (SELECT table_name, column_name, CASE data_type WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS data_type FROM information_schema.columns WHERE table_name IN ({', '.join(f"'{t}'" for t in TABLES)})),
 e AS (SELECT * FROM (VALUES {_values(EXPECTED)}) AS v(table_name, column_name, data_type, present)),
 f AS (SELECT e.*, EXISTS (SELECT 1 FROM k WHERE k.table_name = e.table_name AND (e.column_name IS NULL OR (k.column_name = e.column_name AND (e.data_type IS NULL OR k.data_type = e.data_type)))) AS there FROM e)
 SELECT table_name, coalesce(column_name, '') AS column_name, coalesce(data_type, '') AS data_type, CASE WHEN there = present THEN 'pass' ELSE 'fail' END AS outcome FROM f""")
def schema_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = inspection.registered(spark, **{f"given_{t}": table(spark, sf_dir, t) for t in TABLES})
    known = inspection.columns(spark, names).withColumn("table_name", F.substr("table_name", F.lit(7)))
    rows = inspection.expected_columns(known, spark.createDataFrame(EXPECTED, "table_name string, column_name string, data_type string, present boolean"))
    return rows.select("table_name", F.coalesce("column_name", F.lit("")).alias("column_name"), F.coalesce("data_type", F.lit("")).alias("data_type"), "outcome")


#: What a migration's test asks of its tables: counts with and without a filter, the greatest id, joins, one row, and none.
MIGRATED = [
    ("orders", "SELECT count(*) FROM {orders}", ">=", 1000), ("nations", "SELECT count(*) FROM {nation}", "=", 25), ("no_such_nation", "SELECT count(*) FROM {nation} WHERE n_name = 'ATLANTIS'", "=", 0),
    ("last_nation", "SELECT max(n_nationkey) FROM {nation}", "=", 24), ("first_region", "SELECT r_name FROM {region} ORDER BY r_regionkey LIMIT 1", "<>", ""), ("none", "SELECT r_name FROM {region} WHERE r_regionkey < 0 LIMIT 1", "=", "x"),
    ("joined", "SELECT count(*) FROM {nation} JOIN {region} ON n_regionkey = r_regionkey JOIN {customer} ON c_nationkey = n_nationkey", ">=", 1), ("renamed", "SELECT count(*) FROM {documents} WHERE lang = 'xx'", ">=", 1),
]
_GIVEN = ["orders", "nation", "region", "customer", "documents"]


def _asked(sql: str, prefix: str) -> str:
    return sql.format(**{t: f"{prefix}{t}" for t in _GIVEN})


def _expectation(name: str, sql: str, op: str, expected: str | int) -> str:
    value = f"({_asked(sql, '')})"
    test = f"{value}::DOUBLE >= {expected}" if op == ">=" else f"{value}::VARCHAR IS {'NOT ' if op == '=' else ''}DISTINCT FROM '{expected}'"
    return f"SELECT '{name}' AS name, coalesce({value}::VARCHAR, 'none') AS actual, CASE WHEN {test} THEN 'pass' ELSE 'fail' END AS outcome"


@query(" UNION ALL ".join(_expectation(*x) for x in MIGRATED))
def migration_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    inspection.registered(spark, **{f"given_{t}": table(spark, sf_dir, t) for t in _GIVEN})
    rows = inspection.scalar_expectations(spark, [(name, _asked(sql, "given_"), op, expected) for name, sql, op, expected in MIGRATED])
    return rows.select("name", F.coalesce("actual", F.lit("none")).alias("actual"), "outcome")


_RELEASES = """r AS (SELECT s_suppkey AS release, CASE s_suppkey % 4 WHEN 0 THEN 'release/' || s_nationkey WHEN 1 THEN 'master' WHEN 2 THEN 'feature/x' ELSE 'develop' END AS branch,
   CASE WHEN s_suppkey % 13 = 0 THEN 'next' ELSE 'v' || (s_suppkey % 3) || '.' || (s_suppkey % 12) || CASE WHEN s_suppkey % 5 = 0 THEN '-rc1' WHEN s_suppkey % 5 = 1 THEN '.0' ELSE '' END END AS version FROM supplier),
 l AS (SELECT l_suppkey AS release, l_linenumber AS k, l_returnflag AS path, CASE WHEN l_partkey % 17 = 0 THEN 'nightly' ELSE 'v1.' || (l_partkey % 12) || CASE WHEN l_partkey % 7 = 0 THEN '-rc2' ELSE '' END END AS tag FROM lineitem)"""


@query(f"""WITH {_RELEASES}, d AS (SELECT release, count(*) AS n FROM l WHERE k = 7 GROUP BY release), s AS (SELECT release, min(path) AS p FROM l WHERE k = 6 AND path = 'A' GROUP BY release),
 f AS (SELECT release, count(DISTINCT path) AS n FROM l WHERE k = 5 AND path IN ('R', 'N') GROUP BY release),
 t AS (SELECT release, max([split_part(split_part(tag, '.', 2), '-', 1)::INT, (NOT contains(tag, '-'))::INT]) AS key FROM l WHERE k = 4 AND tag <> 'nightly' GROUP BY release),
 v AS (SELECT *, CASE WHEN version <> 'next' THEN [split_part(version[2:], '.', 1)::INT, split_part(split_part(version, '.', 2), '-', 1)::INT, (NOT contains(version, '-'))::INT] END AS key FROM r)
 SELECT release, 'branch' AS gate, CASE WHEN branch LIKE 'feature%' THEN 'warn' ELSE 'pass' END AS outcome FROM r UNION ALL SELECT r.release, 'clean', CASE WHEN d.n > 0 THEN 'fail' ELSE 'pass' END FROM r LEFT JOIN d ON r.release = d.release
 UNION ALL SELECT r.release, 'secrets', CASE WHEN p IS NULL THEN 'pass' ELSE 'fail' END FROM r LEFT JOIN s ON r.release = s.release UNION ALL SELECT r.release, 'folders', CASE WHEN f.n = 2 THEN 'pass' ELSE 'warn' END FROM r LEFT JOIN f ON r.release = f.release
 UNION ALL SELECT v.release, 'version', CASE WHEN v.key IS NULL OR v.key <= [1, t.key[1], t.key[2]] THEN 'fail' ELSE 'pass' END FROM v LEFT JOIN t ON v.release = t.release""")
def release_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five gates for each supplier as a release; its lines of order stand for changes, tracked files, folders and tags."""
    k = C("s_suppkey")
    part = lambda n: (k % n).cast("string")
    branch = F.when(k % 4 == 0, F.concat(F.lit("release/"), C("s_nationkey").cast("string"))).when(k % 4 == 1, "master").when(k % 4 == 2, "feature/x").otherwise("develop")
    version = F.when(k % 13 == 0, "next").otherwise(F.concat(F.lit("v"), part(3), F.lit("."), part(12), F.when(k % 5 == 0, "-rc1").when(k % 5 == 1, ".0").otherwise("")))
    releases = table(spark, sf_dir, "supplier").select(k.alias("release"), branch.alias("branch"), version.alias("version"))
    p = C("l_partkey")
    tag = F.when(p % 17 == 0, "nightly").otherwise(F.concat(F.lit("v1."), (p % 12).cast("string"), F.when(p % 7 == 0, "-rc2").otherwise("")))
    lines = table(spark, sf_dir, "lineitem").select(C("l_suppkey").alias("release"), C("l_linenumber").alias("k"), C("l_returnflag").alias("path"), tag.alias("tag"))
    one = lambda n: lines.filter(C("k") == n)
    secret = spark.createDataFrame([("A",), ("Z",)], "path string")
    gates = inspection.release_gates(releases, one(7), one(6), secret, one(4), one(5), ["R", "N"])
    return gates.select("release", "gate", "outcome")
