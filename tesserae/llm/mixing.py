"""Mixing sources to target weights, with SQL functions only.

The words of each source, its documents laid end to end in doc_id order, are cut into blocks
of fixed length. A source gets as many slots of the output as its target asks for. For each output shard the
numbers of slots from each source are drawn: a multinomial draw under the condition that the totals are the targets, made by
dealing all slots to shards with one pseudorandom permutation. The slots of a source, shard after shard, map through the
source's own pseudorandom permutation to blocks, pass after pass, and slots and blocks are joined by index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, running_totals, written

C = F.col
ROUNDS = 12
#: Sources up to this number are broadcast (some 100 bytes each); beyond, the join shuffles.
BROADCAST_ROWS = 20_000


def permuted(x: Column, n: Column, key: Column, inverse: bool = False) -> Column:
    """A pseudorandom permutation of 0..n-1 at x: swap-or-not rounds, each its own inverse."""

    def turn(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - at, n)
        return F.when(F.xxhash64(key, r, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1, other).otherwise(at)

    order = F.sequence(F.lit(ROUNDS), F.lit(1)) if inverse else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(order, x.cast("long"), turn)


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0) -> DataFrame:
    """Adds weight and target to sources (source, source_size).

    Sources by code point, null last, take the weights in turn. Targets share the sum of all
    sizes by weight; none is above `limit` times its source's size, and what a capped source
    cannot take is shared by the others by weight.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(C("source").isNull(), "source")
    everything = Window.partitionBy(F.lit(0))
    cap = F.lit(float(limit)) * C("source_size")
    ranked = sources.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))))
    ranked = ranked.withColumn("_ratio", cap / C("weight"))
    by_ratio = everything.orderBy("_ratio", C("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns({
        "_level": (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
        "_place": F.row_number().over(by_ratio),
    })
    level = F.min(F.when(C("_ratio") >= C("_level"), F.struct("_place", "_level"))).over(everything)["_level"]
    return ranked.withColumn("target", F.least(cap, F.coalesce(level, F.lit(0.0)) * C("weight"))).drop("_ratio", "_level", "_place")


def with_source(df: DataFrame, sources: DataFrame) -> DataFrame:
    """df joined with the written table sources on `source`, null with null.

    sources is broadcast if its counted rows are few; a shuffle that AQE can split does the rest.
    """
    right = sources.withColumnRenamed("source", "_source")
    if sources.count() <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return df.join(right, df["source"].eqNullSafe(right["_source"])).drop("_source")


def _unrolled(df: DataFrame, n: str, name: str) -> DataFrame:
    """df with `name`, 0..n-1, in steps of 4096, so that no row holds a long array and a hot source is no single task's work."""
    out = df.filter(C(n) > 0).withColumn("_a", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) div (4096 * 4096)"))))
    out = out.withColumn("_b", F.explode(F.sequence(C("_a") * 4096, F.least(F.expr(f"({n} - 1) div 4096"), C("_a") * 4096 + 4095))))
    out = out.repartition(parts(df.sparkSession), *[C(c) for c in df.columns if c in ("source", "shard")], C("_b"))
    return out.withColumn(name, F.explode(F.sequence(C("_b") * 4096, F.least(C(n) - 1, C("_b") * 4096 + 4095)))).drop("_a", "_b")


def drawn(sources: DataFrame, shard_blocks: int = 1024, seed: int = 1) -> DataFrame:
    """source, n_blocks, shard, n, first: each shard's number n of slots from each source, and the source's slots in shards before.

    sources has source, n_blocks, n_slots, first_slot, all_slots. All shards but the last have shard_blocks slots. Of n only
    numbers above 0 have a row, so a shard has at most as many rows as slots. The same seed gives the same draw.
    """
    rows = _unrolled(sources, "n_slots", "_t")
    place = permuted(C("first_slot") + C("_t"), C("all_slots"), F.lit(seed).cast("long"), inverse=True)
    counts = rows.withColumn("_place", place).withColumn("shard", F.expr(f"_place div {int(shard_blocks)}")).groupBy("source", "n_blocks", "shard").agg(F.count("*").alias("n"))
    return running_totals(counts, ["source", "shard"], {"first": C("n")}, ["source"])


def slots(sources: DataFrame, shard_blocks: int = 1024, seed: int = 1) -> DataFrame:
    """A row for each slot of the output: shard, place (in the shard, from 0), source, block.

    A block comes up at most once in a pass over its source, so at most ceil(n_slots / n_blocks) times.
    """
    # so many tasks, whatever the size of the draw: its rows are few and small, but each becomes up to shard_blocks slots
    draw = written(drawn(sources, shard_blocks, seed)).repartition(parts(sources.sparkSession), "shard")
    by_source = Window.partitionBy("shard").orderBy(C("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    draw = draw.withColumns({"_before": F.coalesce(F.sum("n").over(by_source), F.lit(0)), "_all": F.sum("n").over(Window.partitionBy("shard"))})
    rows = draw.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), C("n") - 1))).withColumn("_t", C("first") + C("_j"))  # n is at most shard_blocks
    key = F.xxhash64(F.lit(seed), C("source"), F.expr("_t div n_blocks"))
    place = permuted(C("_before") + C("_j"), C("_all"), F.xxhash64(F.lit(seed), C("shard")))
    return rows.select("shard", place.alias("place"), "source", permuted(F.pmod(C("_t"), C("n_blocks")), C("n_blocks"), key).alias("block"))


def laid_out(docs: DataFrame, block_words: int = 64, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """(documents, sources), both written: documents have doc_id, source, size, row and `at`, the
    number of words before them in their source."""
    size = F.regexp_count(F.coalesce(C("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    sized = docs.select(C("doc_id"), C("source").cast("string").alias("source"), size.alias("size"), F.xxhash64("text").alias("_tie"))
    placed = written(running_totals(sized, ["source", "doc_id", "_tie"], {"at": C("size")}, ["source"]).withColumn("row", F.monotonically_increasing_id()))
    sources = source_targets(placed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, limit)
    sources = sources.withColumn("n_blocks", F.ceil(C("source_size") / block_words))
    sources = sources.withColumn("n_slots", F.when(C("source_size") > 0, F.round(C("target") * C("n_blocks") / C("source_size"))).otherwise(0).cast("long"))
    earlier = Window.partitionBy(F.lit(0)).orderBy(C("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.withColumns({"first_slot": F.coalesce(F.sum("n_slots").over(earlier), F.lit(0)), "all_slots": F.sum("n_slots").over(Window.partitionBy(F.lit(0)))})
    return placed, written(sources)


def _covered(placed: DataFrame, block_words: int) -> DataFrame:
    """row, _s, _b, from, words: the words of a document, from its word `from` on, that a block of its source has."""
    b = F.lit(block_words)
    blocks = F.sequence(F.expr(f"at div {int(block_words)}"), F.expr(f"(at + size - 1) div {int(block_words)}"))
    covers = placed.filter(C("size") > 0).withColumn("_b", F.explode(blocks))
    begin = F.greatest(C("at"), C("_b") * b)
    return covers.select("row", "doc_id", C("source").alias("_s"), "_b", (begin - C("at")).alias("from"), (F.least(C("at") + C("size"), (C("_b") + 1) * b) - begin).alias("words"))


def mix(docs: DataFrame, block_words: int = 64, shard_blocks: int = 1024, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0, seed: int = 1) -> DataFrame:
    """Per row of docs (doc_id, source, text): doc_id, source, size, source_size, target, taken, shards.

    size counts words (a null text has none); taken counts the words that the shards of the mix take from the
    document, repeats counted, at most ceil(limit) times its size; shards is the number of shards that take any. The same input gives the same
    result. Rows with one doc_id are taken in the order of their texts' hashes. Documents without
    words are never taken; other columns may have any name; an empty table gives no rows.
    """
    placed, sources = laid_out(docs, block_words, weights, limit)
    times = slots(sources, shard_blocks, seed).groupBy("source", "block", "shard").agg(F.count("*").alias("times"))
    # slots unroll from few rows, by whose size Catalyst would broadcast them: they grow with the input
    met = _covered(placed, block_words).join(times.hint("merge"), (C("_b") == C("block")) & C("_s").eqNullSafe(C("source")))
    taken = met.groupBy(C("row").alias("_row"), "shard").agg(F.sum(C("words") * C("times")).alias("_words"))
    taken = taken.groupBy("_row").agg(F.sum("_words").alias("_taken"), F.count("*").alias("_shards"))
    out = placed.join(taken, C("row") == C("_row"), "left").select("doc_id", "source", "size", *[F.coalesce(f"_{c}", F.lit(0)).cast("long").alias(c) for c in ("taken", "shards")])
    return with_source(out, sources.select("source", "source_size", "target")).select("doc_id", "source", "size", "source_size", "target", "taken", "shards")


def mixed_shards(docs: DataFrame, block_words: int = 64, shard_blocks: int = 1024, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0, seed: int = 1) -> DataFrame:
    """The output itself, as pieces of documents: shard, place (of the block in its shard), source, doc_id, from, words.

    A block's pieces stand in the order of doc_id; nulls, ties and empty texts are as in mix().
    """
    placed, sources = laid_out(docs, block_words, weights, limit)
    met = slots(sources, shard_blocks, seed).hint("merge").join(_covered(placed, block_words), (C("_b") == C("block")) & C("_s").eqNullSafe(C("source")))
    return met.select("shard", "place", "source", "doc_id", "from", "words")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """docs in the mix's proportions, whole: each row stands taken / size times, rounded up or
    down by a hash of the document, so that the expected words are those of mix().

    Columns are those of docs, whatever their names. Rows without words (null or empty texts) are not taken; rows that share a doc_id all stand
    as often as the one of them that is taken most; an empty table gives no rows.
    """
    taken = mix(docs, **options)
    share = C("taken") / C("size")
    luck = F.pmod(F.xxhash64(F.lit("mixed"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    times = taken.filter(C("size") > 0).groupBy(C("doc_id").alias("_doc")).agg(F.max(F.floor(share + luck)).cast("int").alias("_times"))
    held = docs.select(C("doc_id").alias("_id"), F.struct(*docs.columns).alias("_held"))
    out = held.join(times, C("_id").eqNullSafe(C("_doc"))).filter(C("_times") > 0)
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), C("_times")))).select("_held.*")
