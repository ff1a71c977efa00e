"""Line dedup, vector codes and the filter audit against brute-force versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tesserae.llm import filter_audit, line_dedup, vector_codes

BLANK = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


# --- lines -------------------------------------------------------------------------------


def line_corpus(n=240):
    rng = random.Random(3)
    shared = ["Shared Footer", " shared footer\t", "SHARED FOOTER", "ÉTÉ", "été", "a", " ", "", " ", "menu | home"]
    texts = []
    for i in range(n):
        lines = [rng.choice(shared) if rng.random() < 0.5 else f"own line {rng.randrange(60)} of {i % 7}" for _ in range(rng.randrange(12))]
        texts.append(None if i % 50 == 9 else "\n".join(["cookie notice"] * (i % 3) + lines))
    return list(enumerate(texts))


def brute_lines(rows, least_docs, least_chars):
    keys = {i: [lower(x.strip(BLANK)) for x in (t or "").split("\n")] for i, t in rows}
    counts = Counter(k for ks in keys.values() for k in set(ks) if len(k) >= least_chars)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, keys[i], strict=True) if counts[k] < least_docs]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize(("least_docs", "least_chars"), [(10, 1), (2, 3), (1, 1), (1000, 1)])
def test_line_dedup(spark, least_docs, least_chars):
    rows = line_corpus()
    docs = spark.createDataFrame([(i, t, "mine", 1) for i, t in rows], "doc_id long, text string, drop_runs string, h1 int").repartition(5)
    wanted = brute_lines(rows, least_docs, least_chars)
    got = {r.doc_id: r for r in line_dedup.line_report(docs, least_docs, least_chars).collect()}
    for i, (n, dropped, kept) in wanted.items():
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_sha256) == (n, dropped, hashlib.sha256(kept.encode()).hexdigest())
    texts = {r.doc_id: r for r in line_dedup.without_common_lines(docs, least_docs, least_chars).collect()}
    assert all(texts[i].text == wanted[i][2] and texts[i].drop_runs == "mine" for i in wanted)


@pytest.mark.parametrize("sample", [1, 10**6])
def test_lines_of_a_sample_change_nothing(spark, monkeypatch, sample):
    """Whether a sample has shown the frequent keys or not, the lines dropped are the same."""
    monkeypatch.setattr(line_dedup, "SAMPLE_LEAST", sample)
    monkeypatch.setattr(line_dedup, "SAMPLE_PER_PART", 0)
    rows = line_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sum(r.n_dropped for r in line_dedup.line_report(docs).collect()) == sum(x[1] for x in brute_lines(rows, 10, 1).values())


def test_lines_are_dealt_once_by_ranges_without_python(spark):
    docs = spark.createDataFrame(line_corpus(20), "doc_id long, text string")
    plan = line_dedup.dropped_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan and "Python" not in plan


@given(st.lists(st.integers(0, 30), unique=True, max_size=20), st.integers(31, 40))
@settings(max_examples=20, deadline=None)
def test_runs_cover_positions(spark, at, n):
    runs = spark.range(1).select(line_dedup._runs(F.lit(sorted(at)).cast("array<int>")).alias("r"), F.lit("\n".join(map(str, range(n)))).alias("t"))
    row = runs.select("r", line_dedup.kept_text(F.col("t"), F.col("r")).alias("kept")).first()
    assert [r["at"] + k for r in row.r for k in range(r["n"])] == sorted(at)
    assert row.kept == "\n".join(str(k) for k in range(n) if k not in at)


# --- vector codes ------------------------------------------------------------------------


@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 6), st.sampled_from([3, 50, 10**6, 10**8]))
@settings(max_examples=60, deadline=None)
def test_exponion_is_exact(seed, k, p, span):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-span, span, (k, p))
    points = np.concatenate([rng.integers(-span, span, (60, p)), entries[rng.integers(0, k, 20)]])
    all_pairs = ((points[:, None, :] - entries) ** 2).sum(2)
    found, error = vector_codes.Codebook.of(entries).nearest(points, rng.integers(0, k, len(points)))
    assert (found == all_pairs.argmin(1)).all() and (error == all_pairs.min(1)).all()


def brute_codes(rows, split=4, size=256, rounds=4):
    rows = [(i, [int(np.floor(1024 * x)) for x in v], label) for i, v, label in sorted(rows)]
    wide = len(rows[0][1]) // split
    points = np.array([[v[p * wide : (p + 1) * wide] for p in range(split)] for _, v, _ in rows])
    books = points[:size].copy()

    def assign(p):
        return ((points[:, p, None, :] - books[None, :, p, :]) ** 2).sum(2)

    for _ in range(rounds):
        for p in range(split):
            own = assign(p).argmin(1)
            for e in set(own.tolist()):
                books[e, p] = [int(x) // int((own == e).sum()) for x in points[own == e, p].sum(0)]
    codes = [assign(p) for p in range(split)]
    text = ",".join(str(x) for p in range(split) for e in books[:, p].tolist() for x in e)
    error = sum(c.min(1) for c in codes)
    by_label = defaultdict(int)
    for (_, _, label), x in zip(rows, error.tolist(), strict=True):
        by_label[label] += x
    return {i: ("".join(f"{c[n].argmin():02x}" for c in codes), int(error[n]), by_label[label], hashlib.sha256(text.encode()).hexdigest()) for n, (i, _, label) in enumerate(rows)}


@pytest.mark.parametrize(("n", "dims", "batch"), [(700, 16, 10_000), (400, 8, 7), (90, 4, 10)])
def test_vector_codes(spark, n, dims, batch):
    rng = np.random.default_rng(n)
    centres = rng.normal(0, 0.3, (12, dims))
    rows = [(int(5 * i - 100), [float(x) for x in np.float32(centres[rng.integers(12)] + rng.normal(0, 0.05, dims))], None if i % 11 == 0 else i % 3) for i in range(n)]
    rows += [(10**6 + i, rows[i][1], 1) for i in range(20)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = vector_codes.compressed(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in got} == brute_codes(rows)


# --- filters -----------------------------------------------------------------------------


def audit_rows():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(160):
        text = " ".join(rng.choices(words[: rng.choice([40, 300])], k=rng.choice([20, 99, 100, 150])))
        text += " NOISE OF CAPITALS" * rng.choice([0, 0, 9]) + rng.choice(["", "", " #", " |"])
        rows.append((i, rng.choice([r[1] for r in rows]) if i % 5 == 4 else None if i % 40 == 3 else text, rng.choice(["en", "fr", None])))
    return rows


def brute_audit(rows, labels):
    firsts = {}
    for i, t, _ in sorted(rows, key=lambda r: r[0]):
        firsts.setdefault(t or "", i)

    def failures(i, t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tests = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": re.search("[#$%&*|]", t) is not None, "E": i > firsts[t]}
        return {k for k, v in tests.items() if v}

    out = {}
    for part in {lang or "" for _, _, lang in rows}:
        docs = [(failures(i, t), *labels.get(i, (0, 0))) for i, t, lang in rows if (lang or "") == part]
        gone = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                hit, after = [d for d in left if f in d[0]], [d for d in left if f not in d[0]]
                failing = sum(f in d[0] for d in docs)
                out[part, order, step] = [len(after), len(hit), failing - len(hit), sum(d[0] == {f} for d in docs), sum(d[1] == 1 for d in hit), sum(d[2] == 1 for d in hit)]
                gone[f] += len(hit)
                left = after
        for (p, order, step), row in out.items():
            if p == part:
                row.append(gone[order[step - 1]])
    return out


def test_filter_audit(spark):
    rows = audit_rows()
    labels = {i: (i % 2, int(i % 3 == 0)) for i, _, _ in rows if i % 4}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    table = spark.createDataFrame([(i, *v) for i, v in labels.items()], "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in filter_audit.filter_audit(docs, table).collect()}
    assert got == brute_audit(rows, labels)


@given(st.dictionaries(st.integers(0, 31), st.integers(0, 1000)))
@settings(max_examples=100, deadline=None)
def test_multilinear_extension(counts):
    f = filter_audit.Multilinear.removal(counts)
    for ones in range(32):
        assert f.corner(ones) == sum(n for mask, n in counts.items() if mask & ones)
    shares = [f.diagonal_derivative(1 << k) for k in range(5)]
    assert sum(shares) == sum(n for mask, n in counts.items() if mask)
    for k in range(5):
        assert shares[k] == sum((Fraction(n, mask.bit_count()) for mask, n in counts.items() if mask >> k & 1), Fraction(0))
        assert (shares[k] * 120).denominator == 1


@pytest.mark.parametrize("slab", [1, 5, 64])
def test_slabs_of_sliced_batches(monkeypatch, slab):
    """Vectors and codes that stand in the middle of a batch are read from their own places."""
    import pyarrow as pa

    monkeypatch.setattr(vector_codes, "SLAB", slab)
    rng = np.random.default_rng(slab)
    books = [vector_codes.Codebook.of(rng.integers(-50, 50, (9, 2))) for _ in range(2)]
    ints, codes = rng.integers(-60, 60, (23, 4)).astype(np.int32), rng.integers(0, 9, (23, 2)).astype(np.uint8)
    plain = pa.array([[x / 1024 + 1e-5 for x in v] for v in ints.tolist()], pa.list_(pa.float64()))
    for vectors, before in ((plain, pa.nulls(23, pa.binary())), (vector_codes._binary(ints), vector_codes._binary(codes))):
        whole = pa.RecordBatch.from_arrays([pa.array(range(23)), vectors, before], names=["vec_id", "_v", "_code"])
        found = [vector_codes._searched(b, books, 4) for b in vector_codes._slabs(iter([whole.slice(0, 10), whole.slice(10, 0), whole.slice(10)]), 4)]
        assert (np.concatenate([x[0] for x in found]) == ints).all()
        want = [((ints[:, 2 * p : 2 * p + 2].astype(np.int64)[:, None, :] - books[p].entries) ** 2).sum(2) for p in range(2)]
        assert (np.concatenate([x[1] for x in found]) == np.stack([w.argmin(1) for w in want], 1)).all()
        assert (np.concatenate([x[2] for x in found]) == sum(w.min(1) for w in want)).all()
