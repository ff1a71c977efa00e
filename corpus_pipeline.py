"""A corpus pipeline of five stages over the table documents; each takes what the one before kept.

In every stage a null text is an empty one, rows that are repeated or share a doc_id are rows of their own unless the stage says otherwise, columns
beside doc_id, text and source may have any name and pass through, texts are read whole, and an empty table gives an empty one.

Tables that a stage's operator leaves in the shared folder go when a later stage of the same thread and sf_dir begins whose docs don't read them, as the stage's
result has then been written. Stages that are chained without a write between read them and keep them. run() drops what is left at its end.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tesserae.llm import mixing, packing, quality_cascade, simhash, suffix_dedup
from tesserae.llm.common import Scratch, documents, shared_dir

#: What stages have left, by thread and input: the stage's place and its tables.
_LEFT: dict[tuple[int, str], list[tuple[int, Scratch]]] = {}


def _stage(spark: SparkSession, docs: DataFrame, sf_dir: str, place: int, build: Callable[[], DataFrame]) -> DataFrame:
    left = _LEFT.setdefault((threading.get_ident(), sf_dir), [])
    if any(before < place for before, _ in left):
        read = set(docs.inputFiles())
        for one in [x for x in left if x[0] < place]:
            if not any(f"{path}/" in file for path in map(_plain, one[1].paths) for file in read):
                one[1].drop()
                left.remove(one)
    with Scratch(spark) as scratch:
        out = build()
    left.append((place, scratch))
    return out


def _plain(path: str) -> str:
    """A path without its scheme, as it stands in every form of the path."""
    return "/" + path.split("://", 1)[-1].lstrip("/") if "://" in path else path.removeprefix("file:")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go; those without words are rejected."""
    return _stage(spark, docs, sf_dir, 0, lambda: quality_cascade.keep_good(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays, that of the least doc_id.

    Rows that share a doc_id stay or go together; a null doc_id stays unless a document with a doc_id has an equal text.
    """
    return _stage(spark, docs, sf_dir, 1, lambda: simhash.one_of_each(docs))


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that an earlier document has go; a null doc_id is the earliest. Documents of which nothing is left go."""
    return _stage(spark, docs, sf_dir, 2, lambda: suffix_dedup.without_repeats(docs, width=50))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mix of sources takes them; those without words go. A null source is a source."""
    return _stage(spark, docs, sf_dir, 3, lambda: mixing.mixed_documents(docs))


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: a row for each piece of a document; an empty document is one end."""
    import public_tokenizers

    return _stage(spark, docs, sf_dir, 4, lambda: packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, window=2048))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("repeat_removal", repeat_removal),
    ("mixing_sources", mixing_sources),
    ("packing_sequences", packing_sequences),
]

#: Fingerprints, permutations and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of sf_dir, written like those of the others. Runs don't touch each other's tables, and leave only their result."""
    docs, root = documents(spark, sf_dir), shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, root)
        out.write.parquet(f"{root}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{name}")
        if k:
            before = Scratch(spark)
            before.paths.append(f"{root}/{STAGES[k - 1][0]}")
            before.drop()
    for _, scratch in _LEFT.pop((threading.get_ident(), root)):
        scratch.drop()
    return docs
