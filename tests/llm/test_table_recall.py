"""Near duplicates of a given table, counted apart from the library: every pair of texts that shares a shingle, by exact Jaccard."""

import collections
import os
import re

import pytest

from tesserae.llm import simhash

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(zip(*[words[k:] for k in range(n)], strict=False)) if len(words) >= n else frozenset([tuple(words)])


def test_near_duplicates_of_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {r.doc_id: shingles(r.text) for r in docs.select("doc_id", "text").collect()}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = collections.Counter()
    for own in holders.values():
        own.sort()
        for k, a in enumerate(own):
            for b in own[k + 1 :]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items() if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n)]
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert len(links) > 50
    assert {r.doc_id for r in simhash.one_of_each(docs).select("doc_id").collect()} == {i for i in sets if find(i) == i}
