"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tesserae.llm import common, induced, license_scan, mixing, ngram_trie, packing, quality_cascade, quality_fm, simhash, suffix_dedup, token_files, tokenizing, winnowing

BPE = public_tokenizers.path("byte_bpe_50k.json")
C = F.col


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, shared passages and repeated lines."""
    rng = random.Random(7)
    lexicon = ["".join(rng.choice("abcdeéñß") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choice(lexicon) for _ in range(n))
    passages = [sentence(25) for _ in range(5)]
    texts = []
    for i in range(150):
        text = sentence(rng.randint(0, 120))
        if i % 6 == 0:
            text += "\n" + rng.choice(passages) + "\n" + sentence(10)
        if i % 10 == 3:
            text = rng.choice(texts)
        if i % 10 == 7 and len(text.split()) > 60:
            w = text.split()
            texts.append(" ".join(w))
            w[30] = "changed"
            text = " ".join(w)
        if i % 15 == 0:
            text += "\nrepeat this line now\n" * 4
        texts.append(text)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    rows = [(i, t, f"src{i % 4}" if i % 7 else None) for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).persist()


# --- tokens ------------------------------------------------------------------------------


@given(st.lists(st.text(alphabet=" \n\tab.,'é日🙂<|endoftext>1 \x1c", max_size=40), max_size=5))
@settings(max_examples=150, deadline=None)
def test_chunks_encode_like_whole_texts(texts):
    own = tokenizing.encoder(BPE)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**16), st.integers(2**59, 2**64 - 1)), max_size=1500))
@settings(max_examples=100, deadline=None)
def test_simple8b_round_trip(ids):
    array = np.array(ids, dtype=np.uint64)
    assert (token_files.decode(token_files.encode(array)) == array).all()


def test_token_files(docs, corpus):
    own, start = tokenizing.encoder(BPE), 0
    got = {r.doc_id: r for r in token_files.token_output(docs, BPE, 2).collect()}
    for doc_id, text in corpus:
        ids = own.tokenizer.encode(text, add_special_tokens=False).ids + [2]
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def plain_best_fit(lengths, window):
    rest = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(rest) if r >= n]
        if fits:
            rest[min(fits, key=lambda k: rest[k])] -= n
        else:
            rest.append(window - n)
    return sorted(rest)


@given(st.lists(st.integers(1, 40), max_size=80))
@settings(max_examples=200, deadline=None)
def test_bulk_best_fit_is_best_fit(lengths):
    places, fills = packing.best_fit_decreasing(dict(collections.Counter(lengths)), 40)
    assert sorted(40 - used for _, n, used in fills for _ in range(n)) == plain_best_fit(lengths, 40)
    slots = collections.defaultdict(list)
    for k, (length, first, window, fit, offset) in enumerate(places):
        stop = next((p[1] for p in places[k + 1 :] if p[0] == length), collections.Counter(lengths)[length])
        for j in range(stop - first):
            slots[window + j // fit].append((offset + j % fit * length, length))
    for pieces in slots.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 40


def test_packing_covers_every_id(docs, corpus):
    own, by_doc, by_sequence = tokenizing.encoder(BPE), collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack(docs, BPE, end_id=1, window=64).collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text in corpus:
        ids = np.array(own.tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == rows[0].sequence_used <= 64
        assert rows[0].sequence_length == (at if at & (at - 1) == 0 else 64)


# --- fingerprints and near duplicates ------------------------------------------------------


def test_winnowing_guarantee_and_ties(spark):
    def chosen(hashes, window):
        out = []
        for i in range(max(len(hashes) - window, 0) + 1):
            own = hashes[i : i + window]
            at = i + max(k for k, h in enumerate(own) if h == min(own))
            if at not in out:
                out.append(at)
        return out

    texts = ["", "a", "a b c d e", "a b c d e f g h i j", "x x x x x x x x x x x x", " ".join(random.Random(1).choice("abc") for _ in range(200))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(winnowing.grams(C("t")).alias("g"), winnowing.winnow(C("t")).alias("f"))
    for r in df.collect():
        assert [x["at"] for x in r.f] == chosen(r.g, 4) and [x["hash"] for x in r.f] == [r.g[i] for i in chosen(r.g, 4)]


def test_edited_texts(docs, corpus):
    got = {r.doc_id: r for r in winnowing.compared(docs).collect()}
    for k, (doc_id, text) in enumerate(corpus):
        after, n = corpus[(k + 1) % len(corpus)][1], len(text) // 4
        r = got[doc_id]
        assert r.edited_sha256 == hashlib.sha256((text[: len(text) - n] + after[:n]).encode()).hexdigest() and r.n_chars == len(text)
    by_text = collections.defaultdict(set)
    for doc_id, text in corpus:
        by_text[text].add(got[doc_id].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_likeness_of_fingerprints(spark, docs, corpus):
    got = {r.doc_id: r for r in winnowing.compared(docs).collect()}
    hashes = lambda shown: {x.split(":")[0] for x in shown.split()}
    jaccard = lambda a, b: len(a & b) / len(a | b)
    for k, (doc_id, _) in enumerate(corpus):
        r, after = got[doc_id], got[corpus[(k + 1) % len(corpus)][0]]
        own = hashes(r.fingerprint)
        assert abs(r.near_edited - jaccard(own, hashes(r.edited_fingerprint))) < 1e-12
        assert abs(r.near_next - jaccard(own, hashes(after.fingerprint))) < 1e-12
    # what is chosen from a text alone is what is chosen there beside other texts, and positions are those of grams
    one = spark.createDataFrame([(t,) for _, t in corpus[:40]], "t string").select(winnowing.winnow(C("t")).alias("f")).collect()
    for (doc_id, _), r in zip(corpus[:40], one, strict=True):
        assert got[doc_id].fingerprint == " ".join(f"{x['hash'] % 2**64:X}:{x['at']}" for x in r.f)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 7, 8, 13])
def test_rolling_hash(spark, n):
    turn = lambda x, by: ((x << (by % 64)) | (x >> (64 - by % 64))) % 2**64
    h = [random.Random(n).getrandbits(64) for _ in range(30)] + [7] * 20
    signed = np.array(h, np.uint64).view(np.int64).tolist()
    got = spark.createDataFrame([(signed,)], "h array<bigint>").select(winnowing.rolled(C("h"), n).alias("g")).first().g
    value = 0
    for x in h[:n]:
        value = turn(value, 1) ^ x
    want = [value]
    for out, into in zip(h, h[n:], strict=False):
        value = turn(value, 1) ^ turn(out, n) ^ into
        want.append(value)
    assert [x % 2**64 for x in got] == want


def brute_components(ids, prints, budget):
    label = {i: i for i in ids}
    near = [(a, b) for a, x in zip(ids, prints, strict=True) for b, y in zip(ids, prints, strict=True) if a < b and bin(x ^ y).count("1") <= budget]
    while True:
        before = dict(label)
        for a, b in near:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def test_simhash(spark, docs, corpus):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [simhash.fingerprint(t) for _, t in corpus]
    want = brute_components([i for i, _ in corpus], prints, 3)
    for (doc_id, _), fp in zip(corpus, prints, strict=True):
        assert (got[doc_id].fingerprint, got[doc_id].component_id) == (f"{fp:016x}", want[doc_id])
    one = spark.createDataFrame([("A  b\tC d",)], "t string").select(F.xxhash64(F.lit("a b c")), F.xxhash64(F.lit("b c d"))).first()
    bits = [sum((h >> k) & 1 for h in one) * 2 > 2 for k in range(64)]
    assert simhash.fingerprint("A  b\tC d") == sum(b << k for k, b in enumerate(bits))


@pytest.mark.parametrize("budget,blocks,heavy", [(3, 4, 1 << 15), (3, 4, 8), (6, 8, 16), (2, 3, 4)])
def test_trie_join_keeps_components(spark, budget, blocks, heavy):
    rng = random.Random(budget * heavy)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for b in base:  # long chains, and many keys that share leading bits
        x = b
        for _ in range(12):
            for _ in range(rng.randint(1, budget)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints |= {(0xABCD << 48) | rng.getrandbits(20) for _ in range(300)}
    prints = sorted(prints)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    links = simhash.trie_links(spark.createDataFrame([(x,) for x in signed], "fp long"), budget, blocks, heavy).collect()
    label = {i: i for i in range(len(prints))}
    place = {x: i for i, x in enumerate(signed)}
    edges = [(place[r.u], place[r.v]) for r in links]
    assert all(bin(prints[a] ^ prints[b]).count("1") <= budget for a, b in edges)
    while True:
        before = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    assert label == brute_components(list(range(len(prints))), prints, budget)


def test_one_of_each(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(200)]
        edit = list(base)
        edit[100] = "other"
        texts += [" ".join(base), " ".join(base), " ".join(edit)]
    kept = simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, 36, 3))


def kept_by_brute_force(texts, least=0.8):
    sets = [simhash.shingles(t, 5) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in [(i, j) for j in range(len(texts)) for i in range(j)]:
        both = len(sets[i] & sets[j])
        if both >= least * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return [i for i in range(len(texts)) if root[i] == i]


def test_alike_texts_among_texts_with_one_fingerprint(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(8):
        tail = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        texts += [" ".join(["same"] * 500 + tail), " ".join(["same"] * 500 + tail[:-2] + ["other", "end"])]
    rng.shuffle(texts)
    assert len({simhash.fingerprint(t, 2) for t in texts}) == 1
    kept = simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(kept) == 8 and sorted(r.doc_id for r in kept) == kept_by_brute_force(texts)


def test_every_alike_text_is_found_whatever_its_fingerprint(spark):
    rng = random.Random(5)
    texts = []
    for k in range(40):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(45, 90) if k % 2 else rng.randint(49, 54))]
        edit = list(base)
        for at in rng.sample(range(len(base)), max(1, len(base) * (2 + k % 19) // 100)) if k % 2 else [len(base) // 2]:
            edit[at] = f"e{rng.randrange(10**6)}"
        texts += [" ".join(base), " ".join(edit)]
    kept = kept_by_brute_force(texts)
    gone = set(range(len(texts))) - set(kept)
    far = [i for i in gone if (simhash.fingerprint(texts[i], 2) ^ simhash.fingerprint(texts[i - 1], 2)).bit_count() > 8]
    assert len(far) >= 3
    found = simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in found) == kept


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=40), st.sets(st.integers(0, 2**64 - 1), max_size=40), st.sampled_from([1, 30, 100]))
@settings(max_examples=60, deadline=None)
def test_sketches_differ_in_no_more_bits_than_their_sets(common, left, right, times):
    def spread(x):  # sets of up to some thousands, so that sketches are of several sizes
        return np.unique(np.array([(v * (2 * k + 1) + k) % 2**64 for v in x for k in range(times)], np.uint64))

    a, b = spread(common | left), spread(common | right)
    sketches = simhash.Sketches(pa.array([simhash.sketch(a), simhash.sketch(b)], pa.binary()))
    apart = int(sketches.apart(np.array([0]), np.array([1]))[0])
    assert apart <= len(np.setxor1d(a, b)) and (apart - len(np.setxor1d(a, b))) % 2 == 0
    assert sketches.apart(np.array([0]), np.array([0]))[0] == 0


def test_texts_that_share_half_are_not_read_in_pairs(spark, monkeypatch):
    rng = random.Random(6)
    blocks = [[f"w{rng.randrange(10**6)}" for _ in range(40)] for _ in range(16)]
    texts = [" ".join(blocks[i] + blocks[j]) for j in range(16) for i in range(j)]
    texts += [t.replace(t.split()[20], "other", 1) for t in texts[::12]]
    read, links = [], simhash._true_links

    def spy(docs, pairs, *more):
        read.append(pairs.count())
        return links(docs, pairs, *more)

    monkeypatch.setattr(simhash, "_true_links", spy)
    kept = simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == kept_by_brute_force(texts) == list(range(120))
    assert sum(read) <= len(texts)


# --- repeats -------------------------------------------------------------------------------


@given(st.lists(st.integers(0, 3), max_size=2000), st.integers(50, 5000))
@settings(max_examples=60, deadline=None)
def test_suffix_array(text, memory):
    got = induced.suffix_array(np.array(text, dtype=np.int64), memory)
    assert got.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@given(st.lists(st.integers(0, 3), min_size=600, max_size=3000), st.sampled_from([16, 200, 1 << 16]))
@settings(max_examples=40, deadline=None)
def test_suffix_array_of_names(text, short):
    """Strings of names are sorted alike by doubling and by induction."""
    before, induced.SHORT = induced.SHORT, short
    try:
        got = induced.suffix_array(np.array(text, dtype=np.int64), 300)
    finally:
        induced.SHORT = before
    assert got.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_few_runs_wait():
    """A queue holds few runs however often it is filled, and stays first in, first out."""
    queue, rng = induced.RunQueue(1 << 20, 4), np.random.default_rng(3)
    keys = rng.integers(0, 50, 4000)
    for k in range(0, 4000, 5):
        queue.push(keys[k : k + 5], np.arange(k, k + 5))
    assert queue.least() == 0 and len(queue.runs) <= 12
    got = np.concatenate([queue.take(b)[1] for b in (20, 51)])
    assert got.tolist() == np.argsort(keys, kind="stable").tolist()


def test_comparable_strings_agree_on_most_of_a_window():
    """Strings that agree on the anchor and 20 bytes on each side share 50 bytes; with 20 on one side alone they can't."""
    anchor, left, right = b"0123456789abcdef", b"L" * 20, b"R" * 20
    strings = [left + anchor + right, b"x" + left + anchor + right + b"y", b"a" * 20 + anchor[::-1] + right, b"b" * 20 + anchor[::-1] + right]
    data = np.frombuffer(b"".join(strings), np.uint8)
    begins = np.cumsum([0, *map(len, strings[:-1])])
    ok = suffix_dedup.comparable(data, begins, begins + [20, 21, 20, 20], np.arange(4), 50)
    assert ok.tolist() == [True, True, False, False]


def brute_removal(rows, width=50):
    least = {}
    for doc_id, text in rows:
        raw = text.encode()
        for i in range(len(raw) - width + 1):
            least[raw[i : i + width]] = min(doc_id, least.get(raw[i : i + width], doc_id))
    out = []
    for doc_id, text in rows:
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - width + 1):
            if least[raw[i : i + width]] < doc_id:
                gone[i : i + width] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(raw), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def test_suffix_dedup(spark, docs, corpus):
    assert sorted(map(tuple, suffix_dedup.removal_report(docs).collect())) == brute_removal(corpus)
    rng = random.Random(9)
    shared = ["a" * 130, "ab" * 70, "".join(rng.choice("xyz ") for _ in range(60))]
    rows = [(rng.randrange(40), "".join(rng.choice([*shared, rng.choice(shared)[: rng.randrange(90)], "".join(rng.choice("ab é") for _ in range(9))]) for _ in range(rng.randrange(7)))) for _ in range(80)]
    got = suffix_dedup.removal_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, got.collect())) == brute_removal(rows)


def test_texts_without_repeats_stay_valid(spark):
    rows = [(1, "é" * 60), (2, "x" + "é" * 60 + "end"), (3, "é" * 60)]
    got = {r.doc_id: r.text for r in suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "é" * 60, 2: "xend"}


# --- language model ------------------------------------------------------------------------


@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=300), st.integers(0, 10**6))
@settings(max_examples=100, deadline=None)
def test_elias_fano(values, wanted):
    values = np.sort(np.array(values))
    coded = ngram_trie.EliasFano.of(values)
    assert (coded.get(np.arange(len(values))) == values).all() and (coded.decode(len(values) // 3, len(values)) == values[len(values) // 3 :]).all()
    assert coded.successor(np.array([0]), np.array([len(values)]), np.array([wanted], np.uint64))[0] == np.searchsorted(values, wanted)


class PlainModel:
    """The model by dictionaries, without quantised values."""

    def __init__(self, texts, order, prior, discount):
        self.counts, self.order, self.prior, self.discount = collections.Counter(), order, prior, discount
        for own in texts:
            for k in range(1, order + 1):
                self.counts.update(tuple(own[i : i + k]) for i in range(len(own) - k + 1))
        ones = [n for g, n in self.counts.items() if len(g) == 1]
        self.total, self.types = sum(ones), len(ones)
        once, twice = ones.count(1), ones.count(2)
        self.d = once / (once + 2 * twice) if once else 0.5
        self.followers = collections.Counter(g[:-1] for g in self.counts)

    def probability(self, gram):
        n = self.counts[gram]
        if len(gram) == 1:
            return (n - self.d) / self.total if n else self.d * self.types / self.total
        shorter, context = self.probability(gram[1:]), self.counts[gram[:-1]]
        if not context:
            return shorter
        if len(gram) == 2:
            return (n + self.prior * shorter) / (context + self.prior)
        return max(n - self.discount, 0) / context + self.discount * self.followers[gram[:-1]] / context * shorter

    def score(self, own):
        return sum(math.log10(self.probability(tuple(own[max(0, i + 1 - self.order) : i + 1]))) for i in range(len(own)))


def lm_tokens(text):
    return [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words(text)] + ["\n end"]


@pytest.mark.parametrize("order,shard_bytes", [(2, 1 << 20), (3, 1 << 20), (3, 400), (4, 5000)])
def test_lm_scores(docs, corpus, order, shard_bytes):
    learned = [lm_tokens(t) for i, t in corpus if zlib.crc32(str(i).encode()) % 10]
    model = PlainModel(learned, order, 20.0, 0.75)
    known = [g[0] for g in model.counts if len(g) == 1]
    context = tuple(learned[0][: order - 1])  # a distribution: all words, and what the class of unknown ones gets
    assert abs(sum(model.probability((*context, w)) for w in known) + model.probability((*context, "unknown")) - 1) < 1e-9
    got = {r.doc_id: r for r in ngram_trie.scored(docs, order=order, prior=20.0, block_bytes=15_000, shard_bytes=shard_bytes).collect()}
    for i, t in corpus:
        own, r = lm_tokens(t), got[i]
        base = sum(math.log10((model.counts[(w,)] + 0.1) / (model.total + 0.1 * (model.types + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 10 == 0, len(own), sum(model.counts[(w,)] > 0 for w in own), model.total)
        assert abs(r.base_score - base) < 1e-6 * len(own) and abs(r.score - model.score(own)) < 0.012 * len(own)


def test_words_that_fill_a_shard_are_spread(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", f"w{rng.randrange(300)}"]) for _ in range(200))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    h, n = ngram_trie._hot_words(docs, 1, 16, 1 << 20)
    assert len(h) == 1 and n[0] >= 8
    model = PlainModel([lm_tokens(t) for i, t in rows if zlib.crc32(str(i).encode()) % 10], 3, 300.0, 0.75)
    for r in ngram_trie.scored(docs, shard_bytes=3000, block_bytes=9000).collect():
        own = lm_tokens(rows[r.doc_id][1])
        assert abs(r.score - model.score(own)) < 0.012 * len(own)


# --- mixing ----------------------------------------------------------------------------------


def water(sizes, weights, limit=3):
    total, target, open_ = sum(sizes.values()), {}, set(sizes)
    while open_:
        rest = total - sum(target.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > limit * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = limit * sizes[s]
        open_ -= over
    return target


def test_mix(docs, corpus):
    rows = mixing.mix(docs, block_words=8).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    want = water(dict(sizes), {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    taken = collections.Counter()
    text = dict(corpus)
    for r in rows:
        assert r.size == len(words(text[r.doc_id])) and r.source_size == sizes[r.source] and r.taken <= 3 * r.size
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 8 + 0.02 * want[s]


def test_shards_are_multinomial_draws(spark, docs, corpus):
    rows = [(i, f"s{i % 3}", " ".join(["w"] * (40 + i % 90))) for i in range(900)]
    many = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    _, sources = mixing.laid_out(many, block_words=8)
    want = {r.source: r.n_slots for r in sources.collect()}
    draw, total = mixing.drawn(sources, shard_blocks=128).collect(), sum(want.values())
    counts, first = collections.Counter(), collections.defaultdict(dict)
    for r in draw:
        counts[r.shard] += r.n
        first[r.source][r.shard] = (r.first, r.n)
    n_shards = -(-total // 128)
    assert sorted(counts) == list(range(n_shards)) and all(counts[k] == 128 for k in range(n_shards - 1))
    chi = 0.0
    for source, by_shard in first.items():
        at = 0
        for k in sorted(by_shard):
            assert by_shard[k][0] == at
            at += by_shard[k][1]
        assert at == want[source]
        own = [by_shard.get(k, (0, 0))[1] for k in range(n_shards - 1)]
        mean = 128 * want[source] / total
        chi += sum((x - mean) ** 2 / mean for x in own)
    free = (n_shards - 1) * (len(want) - 1)
    assert abs(chi - free) < 5 * math.sqrt(2 * free) and n_shards > 30
    assert sorted(map(tuple, draw)) == sorted(map(tuple, mixing.drawn(sources, shard_blocks=128).collect()))
    spread = [r[0] for r in mixing.slots(sources, shard_blocks=128).groupBy(F.spark_partition_id()).count().collect()]
    assert len(spread) == common.parts(spark)  # a small draw unrolls in more than one task


def test_shards_hold_what_is_taken(docs):
    taken, places, shards = collections.Counter(), collections.defaultdict(set), collections.defaultdict(set)
    for r in mixing.mixed_shards(docs, block_words=8, shard_blocks=64).collect():
        taken[r.doc_id] += r.words
        places[r.shard].add(r.place)
        shards[r.doc_id].add(r.shard)
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(places) > 10
    for r in mixing.mix(docs, block_words=8, shard_blocks=64).collect():
        assert (r.taken, r.shards) == (taken[r.doc_id], len(shards[r.doc_id]))


def test_permutation(spark):
    df = spark.range(1000).select(mixing.permuted(C("id"), F.lit(1000), F.lit(5).cast("long")).alias("p"), C("id"))
    back = df.select("id", "p", mixing.permuted(C("p"), F.lit(1000), F.lit(5).cast("long"), inverse=True).alias("b")).collect()
    assert sorted(r.p for r in back) == list(range(1000)) and all(r.b == r.id for r in back)
    assert sum(abs(r.p - r.id) for r in back) > 200_000


# --- quality -----------------------------------------------------------------------------------


def test_quality_rules(docs, corpus):
    got = {r.doc_id: r for r in quality_cascade.quality_report(docs).collect()}
    for i, t in corpus:
        w, r = words(t), got[i]
        lines = [x for x in t.split("\n") if words(x)]
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        seen, covered = collections.Counter(windows), set()
        for k, x in enumerate(windows):
            if seen[x] > 1:
                covered.update(range(k, k + 8))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (r.base_failed and r.kept)


def test_order_of_rules_changes_nothing(docs):
    rules = quality_cascade.base_rules() + quality_cascade.own_rules()
    kept = [sorted(r.doc_id for r in quality_cascade.cascade(docs, order).select("doc_id", "rejected_by").collect() if r.rejected_by is None) for order in (rules, rules[::-1])]
    assert kept[0] == kept[1] == sorted(r.doc_id for r in quality_cascade.keep_good(docs).collect())


def test_a_slow_rule_goes_behind_a_fast_one(docs):
    few = C("n_words") < 60
    slow, fast = quality_cascade.Rule("slow", ("n_words", "n_repeat_words"), few), quality_cascade.Rule("fast", ("n_words",), few)
    never = quality_cascade.Rule("never", ("n_symbols",), C("n_symbols") < 0)
    for rules in ([slow, never, fast], [never, fast, slow]):
        found = quality_cascade.measured(docs, rules)
        assert found[0][0].name == "fast" and found[0][2] > 0.2
        rest = {r.name: share for r, _, share in found[1:]}
        assert rest == {"slow": 0.0, "never": 0.0}  # nothing is left for them to reject


def test_factorisation_identity():
    rng = np.random.default_rng(1)
    machine = quality_fm.Machine(0.3, rng.normal(size=quality_fm.SIZE), rng.normal(size=(quality_fm.SIZE, 4)))
    d, f, x = quality_fm.featured(["some words here, some more", "", "OTHER ones!!"])
    got = machine.logits(d, f, x, 3)
    for k in range(3):
        own = d == k
        fi, xi = f[own], x[own].astype(float)
        pairs = sum(machine.factors[fi[a]] @ machine.factors[fi[b]] * xi[a] * xi[b] for a in range(len(fi)) for b in range(a + 1, len(fi)))
        assert abs(got[k] - (0.3 + machine.linear[fi] @ xi + pairs)) < 1e-3 * max(1, abs(got[k]))


def test_classifier_on_held_out(spark):
    rng = random.Random(5)
    good = lambda: " ".join(rng.choice(["the", "river", "house", "green", "walks", "slowly", "and"]) for _ in range(80)) + "."
    bad = lambda: " ".join(rng.choice(["buy", "###", "now!!", "FREE", "$$$", "|"]) for _ in range(80))
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_fm.classified(docs, labels).collect()}
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert len(held) > 50 and sum(p == y for p, y in held) >= 0.97 * len(held)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)


def test_licenses(spark):
    files = spark.createDataFrame([
        ("a/LICENSE", "Licensed under the Apache License, Version 2.0."), ("a/b/c/x.txt", "plain words"), ("a/b/y.txt", "text\nReleased under the MIT License.\nmore"),
        ("a/b/c/LICENSE.md", "This work is licensed under the GNU General Public License, version 3."), ("q/z.txt", "no licence to kill here, nor anywhere else in this long line"), ("top", None), (None, ""),
        ("a/k.txt", "we thank the license office for help"), ("n/m.txt", "Licensed under CC BY-NC 4.0."),
    ], "path string, text string")
    got = {r.path: (r.license, r.origin, r.inherited) for r in license_scan.scan(files).collect()}
    assert got["a/b/c/x.txt"] == ("GPL-3.0", "a/b/c/LICENSE.md", True)
    assert got["a/b/y.txt"] == ("MIT", "a/b/y.txt", False) and got["a/k.txt"] == ("Apache-2.0", "a/LICENSE", True)
    assert got["q/z.txt"] == (None, None, False) and got["n/m.txt"][0] == "CC-BY-NC-4.0" and got[None] == (None, None, False)


def test_wrapped_licenses():
    wrapped = {
        "MIT": "/*\n * Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files (the \"Software\"), to deal\n * in the Software without restriction, including without limitation the rights\n */",
        "BSD-3-Clause": "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions\n# are met. Neither the name of the copyright holder nor the names of its\n# contributors may be used to endorse or promote products\n",
        "MPL-2.0": "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed with this\n// file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "GPL-3.0": "// SPDX-License-Identifier: GPL-3.0-or-later\nint main() {}",
    }
    matcher = license_scan.Matcher()
    assert {name: matcher.best(text)[0] for name, text in wrapped.items()} == {name: name for name in wrapped}
    assert matcher.best("plain words\n\nthe license office was closed and\nnobody in the public domain of words came")[0] is None


def test_license_files():
    matcher = license_scan.Matcher()
    bsd = """Copyright (c) 2001, Some One

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
    third = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
    after = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"\nAND ANY EXPRESS OR IMPLIED WARRANTIES'
    files = {
        "BSD-2-Clause": bsd + after, "BSD-3-Clause": "BSD 3-Clause License\n\n" + bsd + third + after,
        "Apache-2.0": "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.\n",
        "GPL-3.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n",
        "LGPL-2.1": "                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n",
        "MIT": "MIT License\n\nCopyright (c) 2020 A\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n",
        "ISC": "Copyright 2010 B\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n",
    }
    assert {name: matcher.best(text)[0] for name, text in files.items()} == {name: name for name in files}


def test_license_cosine_by_brute_force():
    rng = random.Random(8)
    bags = [collections.Counter(re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", t.lower())) for _, t in license_scan.TEMPLATES]
    seen = collections.Counter(w for b in bags for w in b)
    idf = lambda w: math.log((1 + len(bags)) / (1 + seen[w])) + 1

    def cosine(a, b):
        norm = lambda x: math.sqrt(sum((n * idf(w)) ** 2 for w, n in x.items()))
        return sum(n * b[w] * idf(w) ** 2 for w, n in a.items()) / (norm(a) * norm(b))

    matcher, lexicon = license_scan.Matcher(), sorted(seen) + ["river", "stone", "walk"]
    for _ in range(60):
        _, text = rng.choice(license_scan.TEMPLATES)
        own = [w if rng.random() > 0.15 else rng.choice(lexicon) for w in re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", text.lower())]
        got = matcher.cosines(own)
        assert all(abs(got.get(k, 0.0) - cosine(collections.Counter(own), b)) < 1e-9 for k, b in enumerate(bags))
        # no window of a template's length around a cue is better than what is found
        words = [rng.choice(lexicon) for _ in range(20)] + own + [rng.choice(lexicon) for _ in range(20)]
        line = " ".join(words)
        found = matcher.scores(line)
        for m in license_scan._CUE.finditer(line):
            at = line.count(" ", 0, m.start())
            for k, b in enumerate(bags):
                n = b.total()
                windows = [words[i : i + n] for i in range(max(0, at - n + 1), min(at, len(words) - n) + 1)]
                best = max((cosine(collections.Counter(w), b) for w in windows if license_scan._CUE.search(" ".join(w))), default=0.0)
                ends = line.count(" ", 0, m.end() - 1)
                if best >= 0.72 and ends == at:
                    assert found.get(k, 0.0) >= best - 1e-9


FREE = "free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."


def _drawn_out(text, mark, width):
    """text in lines of about that many characters, each behind a comment's mark."""
    lines, line = [], ""
    for word in text.split():
        if line and len(line) + len(word) > width:
            lines.append(line)
            line = ""
        line = f"{line} {word}".strip()
    return "\n".join(mark + x for x in [*lines, line])


@pytest.mark.parametrize(("mark", "width"), [("", 10**6), (" * ", 60), ("# ", 72), ("// ", 40)])
def test_each_template_knows_its_own_text(mark, width):
    """Alone, and between code and other comments, whatever stands before its lines."""
    matcher = license_scan.Matcher()
    wrong = []
    for name, text in license_scan.TEMPLATES:
        own = _drawn_out(text, mark, width)
        for whole in (own, f"{mark}Copyright (C) 2020 A Person\n{mark}\n{own}\n{mark}\nint main() {{ return 0; }}\n"):
            if matcher.best(whole)[0] != name:
                wrong.append((name, text[:60], matcher.best(whole)))
    assert wrong == []


@pytest.mark.parametrize(("kind", "version", "program", "name"), [("", "2", "program", "GPL-2.0"), ("", "3", "program", "GPL-3.0"), ("Affero ", "3", "program", "AGPL-3.0"), ("Lesser ", "2.1", "library", "LGPL-2.1"), ("Lesser ", "3", "library", "LGPL-3.0")])
@pytest.mark.parametrize("mark", ["", " * ", "# "])
def test_license_families(kind, version, program, name, mark):
    text = f"This {program} is " + FREE.format(kind, version)
    rest = f" This {program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY. See the GNU Affero, Lesser and General Public Licenses for more details."
    assert license_scan.Matcher().best(_drawn_out(text, mark, 70))[0] == name
    assert license_scan.Matcher().best(_drawn_out(text + rest, mark, 70))[0] == name


def test_license_tags():
    matcher = license_scan.Matcher()
    tags = {"MIT": "MIT", "(MIT OR Apache-2.0)": "Apache-2.0 OR MIT", "GPL-2.0-or-later WITH Classpath-exception-2.0": "GPL-2.0", "LGPL-3.0+ AND MIT": "LGPL-3.0 AND MIT", "gpl-3.0-only */": "GPL-3.0"}
    assert {t: matcher.best(f"// SPDX-License-Identifier: {t}\nint x;")[0] for t in tags} == tags
    assert matcher.best("// SPDX-License-Identifier: Own-1.0\nint x;")[0] is None


def test_choice_of_license_by_brute_force():
    """The greatest cosine, but for longer templates whose further words are all there, on texts of mixed templates."""
    rng, matcher = random.Random(12), license_scan.Matcher()
    bags = [collections.Counter(re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", t.lower())) for _, t in license_scan.TEMPLATES]
    for _ in range(150):
        words = rng.choice(license_scan.TEMPLATES)[1].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(rng.choice(license_scan.TEMPLATES)[1].split())
        text = " ".join(words)
        got = matcher.best(text)
        found = matcher.scores(text)
        windows = {k: collections.Counter(w) for k, (_, w) in matcher.fits(text).items()}
        if not found or max(found.values()) < matcher.least - 1e-9:
            assert got[0] is None
            continue
        best = sorted(found, key=lambda k: (round(found[k], 9), bags[k].total(), license_scan.TEMPLATES[k][0]))[-1]
        for k in sorted(found, key=lambda k: (bags[k].total(), found[k], license_scan.TEMPLATES[k][0]), reverse=True):
            more = {w: n - bags[best][w] for w, n in bags[k].items() if n > bags[best][w]}
            if bags[k].total() > bags[best].total() and found[k] >= max(found[best] - 0.05, matcher.least - 1e-9) and all(windows[k][w] >= n for w, n in more.items()):
                best = k
                break
        assert got[0] == license_scan.TEMPLATES[best][0]


def test_license_columns_that_clash(spark):
    files = spark.createDataFrame([("a/LICENSE", "Released under the MIT License.", "x", 1, "y", True, "f", "g"), ("a/b", None, "x", 1, "y", True, "f", "g")], "path string, text string, license string, origin int, own_license string, inherited boolean, _folder string, `odd.name` string")
    out = license_scan.scan(files)
    assert out.columns == ["path", "_folder", "odd.name", "own_license", "own_score", "license", "origin", "inherited"]
    assert {(r.path, r.license, r.origin, r.inherited) for r in out.collect()} == {("a/LICENSE", "MIT", "a/LICENSE", False), ("a/b", "MIT", "a/LICENSE", True)}


def test_pipeline(spark, docs, tmp_path, corpus):
    docs.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    now = common.documents(spark, str(tmp_path))
    for _, stage in corpus_pipeline.STAGES[:2]:
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{stage.__name__}")
        now = spark.read.parquet(f"{tmp_path}/{stage.__name__}")
    rows = [(r.doc_id, r.text) for r in now.collect()]
    assert len({t for _, t in rows}) == len(rows)
    cut = {r.doc_id: r.text for r in corpus_pipeline.STAGES[2][1](spark, now, str(tmp_path)).collect()}
    windows = collections.defaultdict(set)
    for i, t in cut.items():
        raw = t.encode()
        for k in range(len(raw) - 99):
            windows[raw[k : k + 100]].add(i)
    assert all(len(v) == 1 for v in windows.values())
    lazy = simhash.near_duplicates(docs)
    first, second = corpus_pipeline.run(spark, str(tmp_path)), corpus_pipeline.run(spark, str(tmp_path))
    out = first.collect()
    assert sorted(map(str, out)) == sorted(map(str, second.collect()))
    assert lazy.count() == docs.count()  # the pipeline deletes only tables of its own
    assert out and {r.doc_id for r in out} <= {i for i, _ in rows}
