"""Pair tables (pos, locale, src, dst) over the standard tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

C = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, reads: int = 1) -> DataFrame:
    """A scan of few splits dealt to all cores, for work that costs much more than moving its rows; a table of as many splits as there are cores stays as it is, or of a share of them if its rows would move more than once."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() * reads < cores else scan


def pair_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document and the one before it, by an equi-join on doc_id."""
    docs = table(spark, sf_dir, "documents")
    before = docs.select((C("doc_id") + 1).alias("pos"), C("text").alias("src"))
    return docs.select(C("doc_id").alias("pos"), C("lang").alias("locale"), C("text").alias("dst")).join(before, "pos").select("pos", "locale", "src", "dst")


PAIR_DOC = "pair AS (SELECT b.doc_id AS pos, b.lang AS locale, a.text AS src, b.text AS dst FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)"


def pair_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    after = turns.select("conv_id", (C("turn") - 1).alias("turn"), C("text").alias("dst"))
    return turns.select("conv_id", "turn", C("text").alias("src")).join(after, ["conv_id", "turn"]).select("conv_id", C("turn").alias("pos"), F.lit("en").alias("locale"), "src", "dst")


PAIR_CONV = "pair AS (SELECT a.conv_id, a.turn AS pos, 'en' AS locale, a.text AS src, b.text AS dst FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"


def pair_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda p: F.regexp_extract("html", p, 1)
    return table(spark, sf_dir, "pages").select(C("page_id").alias("pos"), one('<html lang="([a-z]+)"').alias("locale"), one("<h1>([^<]*)</h1>").alias("src"), one("<title>([^<]*)</title>").alias("dst"))


PAIR_PAGE = """pair AS (SELECT page_id AS pos, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS locale, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS src, regexp_extract(html, '<title>([^<]*)</title>', 1) AS dst FROM pages)"""

#: What a source carries behind its text, and what becomes of it, by doc_id modulo their number.
CARRIED = ' See [ZONE_NAME] at https://docs.test/a in user_name_id, 192.0.2.10/24, YYYYMMDDnn, %1$s of %d, DNSSEC NSEC3, 4096-8192 <b>bold</b> settings not (ID '
DAMAGES = [
    CARRIED,
    CARRIED.replace("[ZONE_NAME]", "[ZONE NAME]"),
    CARRIED.replace("https", "http"),
    CARRIED.replace("user_name_id", "user name id"),
    CARRIED.replace("192.0.2.10/24", "192.0.2/24"),
    CARRIED.replace("YYYYMMDDnn", "AAAAMMJJnn"),
    CARRIED.replace("%d", "%s"),
    CARRIED.replace("%d", "%dZ"),
    CARRIED.replace("DNSSEC", "ДНССЕК"),
    CARRIED.replace("4096-8192", "4096"),
    CARRIED.replace("<b>bold</b>", "<b>bold"),
    CARRIED.replace("(ID", "(ID)"),
    CARRIED.replace("not (ID", "(ID") + ' \\"x',
    CARRIED.rstrip(),
    CARRIED + " Twitter [a | b]",
    CARRIED.replace("NSEC3", "NSEK3") + " wоrd",
    CARRIED + " in in in of of in in in in in in in in in in",
    CARRIED + "​ \u0093",
    CARRIED.replace("bold", "bÃ©ld αβ ♪☑✔▲─𝐀 ZZ0Z"),
    CARRIED + " a\u200cb\u2062c\U000e0041d\u180ee\u00adf\u202eg\u0007h\u2028i",
    CARRIED + " déjà\u00a0vu Ê\u00a0la Ää ÃÃ© Â© Å\u0093 Ã\u00ff Ã¨ Ä",
]
#: A word of prose, translated in two of three.
DAMAGES = [x.replace("settings", "настройки") if k % 3 else x for k, x in enumerate(DAMAGES)]
LOCALES = ["en", "ru_RU", "fr", "de", "zh_CN", "es", "el_GR", "fa_IR"]


def _chosen(index: Column, values: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def pair_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with CARRIED behind them, against the same with one of DAMAGES."""
    i = C("doc_id")
    n, k = F.lit(len(DAMAGES)), F.lit(len(LOCALES))
    return spread(table(spark, sf_dir, "documents")).select(
        i.alias("pos"), _chosen(F.pmod(i, k).cast("int"), LOCALES).alias("locale"), F.concat("text", F.lit(CARRIED)).alias("src"), F.concat("text", _chosen(F.pmod(i, n).cast("int"), DAMAGES)).alias("dst")
    )


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


PAIR_DAMAGED = f"pair AS (SELECT doc_id AS pos, ({_list(LOCALES)})[doc_id % {len(LOCALES)} + 1] AS locale, text || {quoted(CARRIED)} AS src, text || ({_list(DAMAGES)})[doc_id % {len(DAMAGES)} + 1] AS dst FROM documents)"


#: Letters with marks of the documents' languages, of Greek and Cyrillic, and the same without; and letters with marks spelt out.
MARKED = ("éèêëàâîïôûùçáíóúñäöüÉÈÊËÀÂÎÏÔÛÙÇÁÍÓÚÑÄÖÜάέήίόύώйЙ", "eeeeaaiiouucaiounaouEEEEAAIIOUUCAIOUNAOUαεηιουωиИ")
SPELT = [("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")]
MARKED_TAIL = " ασφάλεια δεδομένων, новый край 'héritées' %s user_name_id"
MARKED_SOURCE = "The zone of records and data"


def pair_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with Greek and Russian words behind them, a twentieth without their marks, a twentieth with umlauts spelt out."""
    text, i = F.concat("text", F.lit(MARKED_TAIL)), C("doc_id")
    spelt = text
    for mark, plain in SPELT:
        spelt = F.replace(spelt, F.lit(mark), F.lit(plain))
    dst = F.when(i % 20 == 5, F.translate(text, *MARKED)).when(i % 20 == 7, F.translate(spelt, *MARKED)).otherwise(text)
    return spread(table(spark, sf_dir, "documents")).select(i.alias("pos"), C("lang").alias("locale"), F.lit(MARKED_SOURCE).alias("src"), dst.alias("dst"))


def _spelt(text: str) -> str:
    for mark, plain in SPELT:
        text = f"replace({text}, '{mark}', '{plain}')"
    return text


_T = f"(text || {quoted(MARKED_TAIL)})"
PAIR_MARKS = f"pair AS MATERIALIZED (SELECT doc_id AS pos, lang AS locale, '{MARKED_SOURCE}' AS src, CASE doc_id % 20 WHEN 5 THEN translate({_T}, '{MARKED[0]}', '{MARKED[1]}') WHEN 7 THEN translate({_spelt(_T)}, '{MARKED[0]}', '{MARKED[1]}') ELSE {_T} END AS dst FROM documents)"


def pair_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short words in turn with the document's first word, and before or after whole documents."""
    i, w = C("doc_id"), F.split_part("text", F.lit(" "), F.lit(1))
    short = F.repeat(F.lit("in "), (i % 90).cast("int"))
    dst = F.when(i % 5 == 0, F.repeat(F.concat(F.lit("in "), w, F.lit(" ")), 6)).when(i % 5 == 1, F.repeat(F.concat(w, F.lit(" in ")), 6)).when(i % 5 == 2, F.concat(short, F.left("text", F.lit(200)), F.lit(" of of"))).when(i % 5 == 3, F.concat("text", F.lit(" "), short)).otherwise(C("text"))
    return spread(table(spark, sf_dir, "documents")).select(i.alias("pos"), C("lang").alias("locale"), F.lit("x").alias("src"), dst.alias("dst"))


_W = "split_part(text, ' ', 1)"
PAIR_REPEATS = f"pair AS (SELECT doc_id AS pos, lang AS locale, 'x' AS src, CASE doc_id % 5 WHEN 0 THEN repeat('in ' || {_W} || ' ', 6) WHEN 1 THEN repeat({_W} || ' in ', 6) WHEN 2 THEN repeat('in ', doc_id % 90) || left(text, 200) || ' of of' WHEN 3 THEN text || ' ' || repeat('in ', doc_id % 90) ELSE text END AS dst FROM documents)"

#: What stands before a document's sentence in two sources that share its translation, and behind the second: opposites, one of them with a sentence more, a negation, and none.
OPPOSITES = [("Enable the", "Disable the", ""), ("Set", "Unset", ""), ("Do show the", "Do hide the", " And more words"), ("Is", "Is not", ""), ("See", "Inspect", ""), ("Use like", "Use unlike", ""), ("A valid", "A invalid", " x")]


def pair_opposites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources for each document, whose translation is the whole document for both."""
    i = C("doc_id")
    before, after, behind = (_chosen((i % F.lit(len(OPPOSITES))).cast("int"), [x[k] for x in OPPOSITES]) for k in range(3))
    # a side is a number until its source is asked for, so that texts are not read for positions
    src = F.when(C("side") == 0, F.concat(before, F.lit(" "), "text")).otherwise(F.concat(after, F.lit(" "), "text", behind))
    sides = spread(table(spark, sf_dir, "documents"), reads=3).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    return sides.select((2 * i + C("side")).alias("pos"), C("lang").alias("locale"), src.alias("src"), C("text").alias("dst"))


def _opposite(k: int) -> str:
    return f"({_list([x[k] for x in OPPOSITES])})[doc_id % {len(OPPOSITES)} + 1]"


PAIR_OPPOSITES = f"pair AS (SELECT 2 * doc_id AS pos, lang AS locale, {_opposite(0)} || ' ' || text AS src, text AS dst FROM documents UNION ALL SELECT 2 * doc_id + 1, lang, {_opposite(1)} || ' ' || text || {_opposite(2)}, text FROM documents)"
