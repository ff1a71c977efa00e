"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import filter_audit, license_scan, line_dedup, mixing, ngram_trie, packing, quality_cascade, quality_fm, simhash, suffix_dedup, token_files, vector_codes, winnowing
from .common import documents


def _byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(license_scan.as_tree(documents(spark, sf_dir)))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared(documents(spark, sf_dir), gram=5, window=4)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_output(documents(spark, sf_dir), _byte_bpe(), end_id=2)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, budget=3)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.scored(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), _byte_bpe(), end_id=1, window=2048)


def op8_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.classified(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(documents(spark, sf_dir), width=50)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # which of several rules rejects a row first depends on their order, so on times; the verdict doesn't
    return quality_cascade.quality_report(documents(spark, sf_dir)).drop("rejected_by")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir), least_docs=10, least_chars=1).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), split=4, size=256, rounds=4)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_fingerprints, op3_token_output, op4_simhash, op5_lm_scoring,
        op6_mixing, op7_packing, op8_quality_fm, op9_suffix_dedup, op10_quality_rules,
        op11_line_dedup, op12_vector_codes, op13_filter_audit,
    )
}
OP9_SQL = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
 w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
 m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
 g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS b FROM w JOIN m USING (s) WHERE doc_id > least),
 r AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (b <> coalesce(before, -2) + 1) AS n_spans FROM (SELECT doc_id, b, lag(b) OVER (PARTITION BY doc_id ORDER BY b) AS before FROM g) GROUP BY doc_id),
 k AS (SELECT doc_id, string_agg(substr(h, 2 * b + 1, 2), '' ORDER BY b) AS kept FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS b FROM d) a ANTI JOIN g USING (doc_id, b) GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN r ON d.doc_id = r.doc_id LEFT JOIN k ON d.doc_id = k.doc_id"""

OP10_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
 v AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
 r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS k FROM v) WHERE k > 1) GROUP BY doc_id),
 f AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
   len(regexp_extract_all(t, '\p{Lu}')) AS n_capitals, len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters FROM d LEFT JOIN r ON d.doc_id = r.doc_id),
 b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (10 * n_symbols > n_words OR 100 * n_dup_lines > 40 * n_lines OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 100 * n_stutters > 25 * n_words OR 100 * n_capitals > 35 * word_chars) AS kept FROM b"""

OP11_SQL = r"""WITH l AS (SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
 k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
 c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON k.key = c.key GROUP BY doc_id"""


def _op12_sql(split: int = 4, size: int = 256, rounds: int = 4) -> str:
    """Each part's integers against all entries, round by round; inner products of lists are exact as doubles."""
    steps = [
        "k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"p AS MATERIALIZED (SELECT vec_id, label, part, v[part * len(v) // {split} + 1 : (part + 1) * len(v) // {split}] AS x FROM k, (SELECT unnest(range({split})) AS part))",
        f"e0 AS MATERIALIZED (SELECT part, dense_rank() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS y FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {size}))",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT vec_id, label, part, x, min(struct_pack(d := d, entry := entry)) AS best FROM "
            f"(SELECT p.*, e.entry, list_inner_product(x, x) - 2 * list_inner_product(x, y) + list_inner_product(y, y) AS d FROM p JOIN e{r} e USING (part)) GROUP BY vec_id, label, part, x)"
        )
        if r < rounds:
            steps.append(f"m{r} AS (SELECT part, entry, list(q ORDER BY i) AS y FROM (SELECT part, best.entry AS entry, i, floor(sum(x[i]) / count(*)) AS q FROM a{r}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM p) + 1)) AS i) GROUP BY ALL) GROUP BY part, entry)")
            steps.append(f"e{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{r}.y, e{r}.y) AS y FROM e{r} LEFT JOIN m{r} USING (part, entry))")
    steps.append(f"s AS (SELECT sha256(string_agg(array_to_string(list_transform(y, lambda c: c::BIGINT::VARCHAR), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM e{rounds})")
    steps.append(f"c AS (SELECT vec_id, label, string_agg(printf('%02x', best.entry::INT), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id, label)")
    return "WITH " + ",\n ".join(steps) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM c, s"


OP13_SQL = r"""WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
 l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
 m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t),
   regexp_matches(t, '[#$%&*|]'), w.doc_id > min(w.doc_id) OVER (PARTITION BY t)] AS fails FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
 c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
 f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest(range(1, 6)) AS k),
 o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS o, a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
 s AS (SELECT c.part, filter_order, step, o[step] AS k, n, good, toxic, fails[o[step]] AS fails_it, len(list_filter(o[1 : step - 1], lambda j: fails[j])) > 0 AS gone, len(list_filter(fails, lambda b: b)) AS n_fails FROM c, o, (SELECT unnest(range(1, 6)) AS step)),
 r AS (SELECT part, filter_order, step, k, coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fails_it), 0) AS removed, coalesce(sum(n) FILTER (gone AND fails_it), 0) AS redundant,
   coalesce(sum(n) FILTER (fails_it AND n_fails = 1), 0) AS unique_fails, coalesce(sum(good) FILTER (NOT gone AND fails_it), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND fails_it), 0) AS toxic_lost FROM s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
 (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley FROM r"""

ORACLES: dict[str, str] = {"op9_suffix_dedup": OP9_SQL, "op10_quality_rules": OP10_SQL, "op11_line_dedup": OP11_SQL, "op12_vector_codes": _op12_sql(), "op13_filter_audit": OP13_SQL}
