"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tesserae.llm import filter_audit, license_scan, line_dedup, mixing, ngram_trie, packing, quality_cascade, quality_fm, simhash, suffix_dedup, token_files, vector_codes, winnowing

BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, rejected_by string, n_words int, target double, _tie int, block int, words string, _held string, `group` string, fp string"


def odd_rows():
    rng = random.Random(4)
    words = [" ".join(rng.choice(["the", "zone", "élan", "日本", "is", "of", "alpha", "beta", "gamma", "😀"]) for _ in range(60)) for _ in range(12)]
    texts = [
        (None, "no id " + words[0]), (1, None), (2, ""), (3, " \n\t "), (4, words[1]), (4, words[1]), (4, words[2]), (5, words[1]), (6, "one"),
        (7, words[3] + "\n" + words[4]), (8, words[4] + " tail"), (9, "x " * 60_000), (10, "a" * 150_000), (11, "퟿" + words[5]), (12, "line\n" * 50),
        (13, "Released under the MIT License.\n" + words[6]), (14, words[7] + "  double  spaces "), (-3, words[8]), (2**40, words[9]),
    ]
    return [(i, t, "en", None if k % 5 == 0 else f"src{k % 3}", len(t or ""), 1, "r", "mine", 2, 3.0, 4, 5, "w", "h", "g", "f") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).persist()


OPERATORS = {
    "license": (lambda d: license_scan.scan(d.select("*", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"))), ["own_license", "license", "origin", "inherited"]),
    "winnowing": (winnowing.compared, ["fingerprint", "edited_fingerprint", "near_edited", "near_next"]),
    "tokens": (lambda d: token_files.token_output(d, BPE, 2), ["start", "n_tokens", "ids_crc32"]),
    "simhash": (simhash.near_duplicates, ["fingerprint", "component_id"]),
    "lm": (ngram_trie.scored, ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]),
    "mixing": (mixing.mix, ["size", "source_size", "target", "taken"]),
    "fm": (lambda d: quality_fm.classified(d, d.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))), ["held_out", "score", "predicted"]),
    "suffix": (suffix_dedup.removal_report, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    "rules": (quality_cascade.quality_report, ["n_words", "base_failed", "kept"]),
    "lines": (lambda d: line_dedup.line_report(d, 2), ["n_lines", "n_dropped", "kept_sha256"]),
    "without lines": (lambda d: line_dedup.without_common_lines(d, 2), ["text", "row", "_held"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each(odd, name):
    build, columns = OPERATORS[name]
    rows = build(odd).collect()
    assert len(rows) == odd.count() and set(columns) <= set(rows[0].asDict())
    ids = lambda rs: sorted(str(r.doc_id) for r in rs)
    assert ids(rows) == ids(odd.select("doc_id").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(odd, name):
    assert OPERATORS[name][0](odd.filter("false")).collect() == []


def test_packing_edges(odd):
    rows = packing.pack(odd, BPE).collect()
    assert len({r.sequence_id for r in rows if r.length == 2048}) == sum(r.length == 2048 for r in rows)
    assert packing.pack(odd.filter("false"), BPE).collect() == []


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns(spark, odd, stage):
    for docs in (odd, odd.filter("false")):
        out = corpus_pipeline.STAGES[stage][1](spark, docs, "")
        assert out.columns == docs.columns
        assert (out.count() > 0) == (docs is odd)


def test_reruns_agree(odd):
    again = odd.repartition(5)
    for name in ("mixing", "simhash", "suffix", "tokens", "winnowing", "lines"):
        build, _ = OPERATORS[name]
        a, b = (sorted(map(str, build(d.dropDuplicates(["doc_id"]).filter("doc_id is not null") if name == "tokens" else d).collect())) for d in (odd, again))
        if name != "tokens":  # of rows with one doc_id any may stay there
            assert a == b, name


def test_audit_edges(odd):
    labels = odd.select("doc_id", F.lit(1).alias("quality"), F.lit(None).cast("int").alias("toxic"), "lang")
    rows = filter_audit.filter_audit(odd.withColumn("lang", F.when(F.col("doc_id") > 6, F.col("lang"))), labels).collect()
    assert {r.part for r in rows} == {"", "en"} and len(rows) == 1200
    for part in ("", "en"):
        own = [r for r in rows if r.part == part]
        n = odd.filter("doc_id > 6" if part else "coalesce(doc_id, 0) <= 6").count()
        assert all(r.kept + sum(q.removed for q in own if q.filter_order == r.filter_order and q.step <= r.step) == n for r in own)
        assert all(r.toxic_lost == 0 for r in own)
    assert filter_audit.filter_audit(odd.filter("false"), labels).collect() == []
    assert len(filter_audit.filter_audit(odd, labels.filter("false")).collect()) == 600


def test_code_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [1.0, 2.0, 3.0, 4.0], None), (1, None, 1), (2, [1.0, None, 3.0, 4.0], 1), (4, [1.0, nan, 0.0, 0.0], 1), (5, [inf, 0.0, 0.0, 0.0], 1), (None, [1.0, 2.0, 3.0, 4.0], None), (7, [0.5, -0.5, 0.25, 1e3], 2), (7, [0.5, -0.5, 0.25, 1e3], 2), (8, [1.0], 2)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, _v int").repartition(3)
    got = vector_codes.compressed(table).collect()
    assert sorted(str(r.vec_id) for r in got) == ["3", "7", "7", "None"] and all(r.error == r.label_error == 0 for r in got)
    assert len({r.codebooks_sha256 for r in got}) == 1 and len({r.code for r in got if r.vec_id == 7}) == 1
    assert vector_codes.compressed(table.filter("false")).collect() == []
    with pytest.raises(OverflowError):
        vector_codes.exact_type(np.array([[1 << 31] * 4]))
    with pytest.raises(ValueError, match="divide"):
        vector_codes.compressed(table.filter("vec_id = 8"))


def test_stages_chain_without_a_write(spark, odd, tmp_path):
    """All five stages, lazily one after the other, give what they give when each is written; a second caller's stages disturb nothing."""
    docs = odd.filter("doc_id IS NOT NULL")
    lazy = docs
    for _, stage in corpus_pipeline.STAGES:
        lazy = stage(spark, lazy, "lazy")
    other = corpus_pipeline.STAGES[1][1](spark, docs, "lazy")
    n = lazy.count()
    assert n > 0 and other.count() > 0
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    written = corpus_pipeline.run(spark, str(tmp_path))
    assert written.count() == n and sorted(map(str, lazy.select("doc_id", "length").collect())) == sorted(map(str, written.select("doc_id", "length").collect()))
    assert not [k for k in corpus_pipeline._LEFT if k[1] not in ("", "lazy")]


def test_a_written_stage_frees_what_it_read(spark, odd, tmp_path):
    left = lambda: [s for k, v in corpus_pipeline._LEFT.items() if k[1] == "freed" for _, s in v if s.paths]
    out = corpus_pipeline.STAGES[1][1](spark, odd, "freed")
    held = left()
    out.write.parquet(str(tmp_path / "one"))
    corpus_pipeline.STAGES[2][1](spark, spark.read.parquet(str(tmp_path / "one")), "freed")
    assert held and not [s for s in held if s.paths]
