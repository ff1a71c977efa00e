"""Running sums, carried values and islands over rows numbered within a file, however long the file.

Rows are dealt by file and by block of numbers, not by file alone. What a block hands on - its sum, its last value - is one row,
and only these rows of a file come together. A file of a billion lines is a quarter of a million such rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

C = F.col
BLOCK = 4096


def _with_blocks(rows: DataFrame, order: str, block: int) -> DataFrame:
    return rows.withColumn("_block", F.floor(C(order) / block))


def _handed_on(held: DataFrame, within: list[str], sums: list[str], lasts: list[str], order: str) -> DataFrame:
    """For each block of a file what the blocks before it hand on: `_b_` + name; keys as `_w_` + name and `_block2`."""
    each = held.groupBy(*within, "_block").agg(
        *[F.sum(c).alias(f"_s{c}") for c in sums],
        *[F.max_by(F.struct(C(c)), F.when(C(c).isNotNull(), C(order))).alias(f"_s{c}") for c in lasts],
    )
    before = Window.partitionBy(*within).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return each.select(
        *[C(c).alias(f"_w_{c}") for c in within], C("_block").alias("_block2"),
        *[F.coalesce(F.sum(f"_s{c}").over(before), F.lit(0)).alias(f"_b{c}") for c in sums],
        *[F.last(f"_s{c}", ignorenulls=True).over(before)[c].alias(f"_b{c}") for c in lasts],
    )


def _met(held: DataFrame, handed: DataFrame, within: list[str]) -> DataFrame:
    on = C("_block") == C("_block2")
    for c in within:
        on = on & C(c).eqNullSafe(C(f"_w_{c}"))
    return held.join(handed, on, "left")


def running_sums(rows: DataFrame, within: list[str], order: str, sums: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """rows with a bigint for each of `sums`: the sum of its values in the rows of a file before this one, by the whole number `order`.

    Null values count as 0. Rows of equal `order` are taken in some order.
    """
    held = _with_blocks(rows.withColumns({f"_v_{k}": F.coalesce(v.cast("long"), F.lit(0)) for k, v in sums.items()}), order, block)
    names = [f"_v_{k}" for k in sums]
    local = Window.partitionBy(*within, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = _met(held.withColumns({f"_l{c}": F.coalesce(F.sum(c).over(local), F.lit(0)) for c in names}), _handed_on(held, within, names, [], order), within)
    return out.select(*rows.columns, *[(C(f"_l_v_{k}") + C(f"_b_v_{k}")).alias(k) for k in sums])


def carried(rows: DataFrame, within: list[str], order: str, values: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """rows with a column for each of `values`: its last value that isn't null in this row or in a row of the file before it."""
    held = _with_blocks(rows.withColumns({f"_v_{k}": v for k, v in values.items()}), order, block)
    names = [f"_v_{k}" for k in values]
    local = Window.partitionBy(*within, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = _met(held.withColumns({f"_l{c}": F.last(c, ignorenulls=True).over(local) for c in names}), _handed_on(held, within, [], names, order), within)
    return out.select(*rows.columns, *[F.coalesce(f"_l_v_{k}", f"_b_v_{k}").alias(k) for k in values])


def islands(rows: DataFrame, within: list[str], order: str, start: Column, name: str = "island", block: int = BLOCK) -> DataFrame:
    """rows with the number of the island that they are in: it grows by one at each row where `start` is true; 0 before the first."""
    one = F.coalesce(start, F.lit(False)).cast("long")
    return running_sums(rows.withColumn("_one", one), within, order, {name: C("_one")}, block).withColumn(name, C(name) + C("_one")).drop("_one")


def _entry(pieces: Column) -> Column:
    """id and str of an entry's lines (line, kind, t) in order: each keyword opens its field, other quoted lines go on with the one that is open."""
    start = F.struct(*[F.lit(v).alias(k) for k, v in (("open", ""), ("id", ""), ("str", ""), ("closed", False))])

    def step(a: Column, x: Column) -> Column:
        kind, t, more = x["kind"], x["t"], F.concat(F.lit("\n"), x["t"])
        opened = F.when(kind == "more", a["open"]).when(kind == "end", "").otherwise(kind)
        ids = F.when(kind == "id", t).when((kind == "more") & (a["open"] == "id"), F.concat(a["id"], more)).otherwise(a["id"])
        strs = F.when(kind == "str", t).when((kind == "more") & (a["open"] == "str"), F.concat(a["str"], more)).otherwise(a["str"])
        new = F.struct(opened.alias("open"), ids.alias("id"), strs.alias("str"), ((kind == "end") & (a["str"] != "")).alias("closed"))
        return F.when(a["closed"], a).otherwise(new)

    return F.aggregate(pieces, start, step)


def quoted_map(lines: DataFrame, path: str = "path", line: str = "line", text: str = "text", block: int = BLOCK) -> DataFrame:
    """path, msgid, msgstr of catalogue lines, each the source's own quoted text with its lines of continuation; of equal msgids the last one counts.

    A line `msgid "` opens an entry, `msgstr "` its text; lines that begin with a quote go on with what was opened last, until an empty line. An empty line
    ends an entry that has a text. Other lines are passed over. The header's empty msgid, and entries without a text, are left out.
    """
    value = C(text)
    kind = F.when(value.startswith('msgid "'), "id").when(value.startswith('msgstr "'), "str").when(value.startswith('"'), "more").when(value == "", "end")
    rows = lines.select(path, line, value.alias("_t"), kind.alias("_kind")).filter(C("_kind").isNotNull())
    rows = islands(rows, [path], line, C("_kind") == "id", "_entry", block).filter(C("_entry") > 0)
    own = F.when(C("_kind") == "id", F.substr(C("_t"), F.lit(7))).when(C("_kind") == "str", F.substr(C("_t"), F.lit(8))).otherwise(C("_t"))
    one = F.struct(C(line).alias("line"), C("_kind").alias("kind"), own.alias("t"))
    entries = rows.groupBy(path, "_entry").agg(_entry(F.array_sort(F.collect_list(one))).alias("_e"))
    found = entries.filter(C("_e.str") != "").select(path, "_entry", T.strip(C("_e.id")).alias("msgid"), T.strip(C("_e.str")).alias("msgstr"))
    return found.filter(C("msgid") != '""').groupBy(path, "msgid").agg(F.max_by("msgstr", "_entry").alias("msgstr"))
