"""Words that lost their marks, by the company they keep.

A bare word is suspect where the catalogue writes it with marks at least as often: with the marks dropped (metadonnees), or spelt out as German does (fuer).
Entries without any marks that hold two words whose marked spelling dominates show which words were damaged; those words are then found in all entries.
Normal forms are made by Python for distinct words, once each; all else is joins and counts by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.similarity import word_forms_udf
from ..sources.shared import kept

C = F.col
WORD = r"[\p{L}\p{Nl}\p{No}]{3,}"
#: Marked spellings a word must have, and how many times the bare ones, to be hard to defend; bare words that give an entry away.
DOMINANT, TIMES, SEEDS = 5, 5, 2


def words(text: Column) -> Column:
    return T.find(text, WORD)


def with_forms(distinct: DataFrame, word: str = "word") -> DataFrame:
    """Distinct words with folded (case), plain (without marks) and spelt (marks as letters); bare if the three are equal."""
    made = distinct.withColumn("_f", word_forms_udf(word))
    return made.select(*distinct.columns, "_f.folded", "_f.plain", "_f.spelt").withColumn("bare", (C("folded") == C("plain")) & (C("folded") == C("spelt")))


def spellings(counts: DataFrame) -> DataFrame:
    """locale, key, n_bare, n_marked of counted words (locale, word, n and the forms): under a key are all words that lose or spell out their marks to it."""
    dropped = counts.select("locale", C("plain").alias("key"), "bare", "n")
    spelt = counts.filter(C("spelt") != C("folded")).select("locale", C("spelt").alias("key"), "bare", "n")
    amount = lambda test: F.sum(F.when(test, C("n")).otherwise(0))
    return dropped.unionByName(spelt).groupBy("locale", "key").agg(amount(C("bare")).alias("n_bare"), amount(~C("bare")).alias("n_marked"))


def diacritics(pairs: DataFrame, literals: tuple[str, ...] = ()) -> DataFrame:
    """locale, pos, words of pairs (locale, pos, src, dst) whose target has damaged words, sorted, without regard to case.

    Words of the source, compared without marks, are names or loans and never damaged, nor are `literals`. Null texts are empty.
    """
    rows = pairs.select("locale", "pos", *[F.coalesce(C(c), F.lit("")).alias(c) for c in ("src", "dst")])
    own = kept(rows.select("locale", "pos", F.explode(words(T.prose_mask(C("dst")))).alias("word")))  # texts are masked once
    counts = kept(with_forms(own.groupBy("locale", "word").agg(F.count("*").alias("n"))))
    marked = spellings(counts).filter((C("n_marked") > 0) & (C("n_marked") >= C("n_bare"))).select(
        C("locale").alias("_l"), C("key").alias("_key"), ((C("n_marked") >= DOMINANT) & (C("n_marked") >= TIMES * C("n_bare"))).alias("strong"))
    open_ = counts.filter(C("bare") & ~C("word").isin(*literals or [""])).join(marked, C("locale").eqNullSafe(C("_l")) & (C("folded") == C("_key"))).select(
        C("locale").alias("_l"), C("word").alias("_w"), "folded", "strong")
    # of all words only the suspect ones are told apart by entry
    found = own.join(open_, C("locale").eqNullSafe(C("_l")) & (C("word") == C("_w"))).select("locale", "pos", "word", "folded", "strong").distinct()
    found = kept(found)
    places = found.select(C("locale").alias("_l"), C("pos").alias("_p")).distinct()
    at = C("locale").eqNullSafe(C("_l")) & (C("pos") == C("_p"))
    # words of the sources of these entries alone
    source = rows.join(places, at, "left_semi").select("locale", "pos", F.explode(F.array_distinct(words(C("src")))).alias("word"))
    forms = with_forms(source.select("word").distinct()).select(C("word").alias("_w"), "plain")
    source = source.join(forms, C("word") == C("_w")).select(C("locale").alias("_l"), C("pos").alias("_p"), "plain").distinct()
    suspect = kept(found.join(source, at & (C("folded") == C("plain")), "left_anti"))
    seeds = suspect.groupBy("locale", "pos").agg(F.count_if("strong").alias("k")).filter(C("k") >= SEEDS).select(C("locale").alias("_l"), C("pos").alias("_p"))
    # an entry with a mark anywhere, also in what the mask blanks, gives nothing away
    raw = rows.join(seeds, at, "left_semi").select("locale", "pos", F.explode(F.array_distinct(words(C("dst")))).alias("word"))
    bare = with_forms(raw.select("word").distinct()).select(C("word").alias("_w"), "bare")
    clean = raw.join(bare, C("word") == C("_w")).groupBy("locale", "pos").agg(F.bool_and("bare").alias("all_bare")).filter("all_bare").select(C("locale").alias("_l"), C("pos").alias("_p"))
    damaged = suspect.join(clean, at, "left_semi").select(C("locale").alias("_l"), C("folded").alias("_f")).distinct()
    hit = suspect.join(damaged, C("locale").eqNullSafe(C("_l")) & (C("folded") == C("_f")), "left_semi")
    return hit.groupBy("locale", "pos").agg(F.sort_array(F.collect_set("folded")).alias("words"))
