"""Compiled catalogues (.mo): the binary format that gettext's readers take."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import framed

C = F.col

MAGIC = 0x950412DE


def compile_entries(entries: list[tuple[str, str]]) -> bytes:
    """(key, value) pairs as one file; later pairs win, keys are sorted by their bytes."""
    own = sorted({k.encode(): v.encode() for k, v in entries}.items())
    n = len(own)
    at = 28 + 16 * n
    places, texts = [], []
    for which in (0, 1):
        for pair in own:
            places.append(struct.pack("<2I", len(pair[which]), at))
            texts += [pair[which], b"\0"]
            at += len(pair[which]) + 1
    return b"".join([struct.pack("<7I", MAGIC, 0, n, 28, 28 + 8 * n, 0, 28 + 16 * n), *places, *texts])


def read(raw: bytes) -> dict[str, str]:
    return dict(pairs(raw))


def pairs(raw: bytes) -> Iterator[tuple[str, str]]:
    """The keys and values of a compiled file, in the order of the file."""
    magic, _, n, keys, values = struct.unpack_from("<5I", raw)
    if magic != MAGIC:
        raise ValueError("not a compiled catalogue")

    def text(table: int, i: int) -> str:
        size, at = struct.unpack_from("<2I", raw, table + 8 * i)
        return raw[at : at + size].decode()

    for i in range(n):
        yield text(keys, i), text(values, i)


def faults(entries: DataFrame) -> DataFrame:
    """path, pos, fault of translated entries that a strict compiler refuses: newline (a text and its source don't both begin, or end, with a line feed),
    or duplicate (a msgid, in its context, that an earlier entry has). Obsolete and fuzzy entries are not looked at."""
    live = entries.filter(~C("obsolete") & ~C("is_header") & ~C("is_fuzzy"))
    texts = F.when(F.size("plurals") > 0, F.map_values("plurals")).otherwise(F.array("msgstr"))
    uneven = F.exists(F.filter(texts, lambda t: t != ""), lambda t: (t.startswith("\n") != C("msgid").startswith("\n")) | (t.endswith("\n") != C("msgid").endswith("\n")))
    first = live.groupBy(C("path").alias("_p"), C("msgctxt").alias("_c"), C("msgid").alias("_m")).agg(F.min("pos").alias("_first"))
    rows = live.join(first, (C("path") == C("_p")) & C("msgctxt").eqNullSafe(C("_c")) & (C("msgid") == C("_m")))
    kinds = F.array_compact(F.array(F.when(uneven, "newline"), F.when(C("pos") > C("_first"), "duplicate")))
    return rows.select("path", "pos", F.explode(kinds).alias("fault"))


def compiled(entries: DataFrame, strict: bool = False) -> DataFrame:
    """path, content of catalogues: live, not fuzzy entries with a text; plural forms joined by NUL. strict: catalogues with faults() are left out."""

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = rows.sort_values("pos")
        return pd.DataFrame({"path": [key[0]], "content": [compile_entries(list(zip(own["key"], own["value"], strict=True)))]})

    if strict:
        entries = entries.join(faults(entries).select("path").distinct(), "path", "left_anti")
    plural = F.size("plurals") > 0
    key = F.when(plural, F.concat_ws("\x00", "msgid", "msgid_plural")).otherwise(C("msgid"))
    key = F.when(C("msgctxt").isNotNull(), F.concat_ws("\x04", C("msgctxt"), key)).otherwise(key)
    forms = F.transform(F.array_sort(F.map_keys("plurals")), lambda k: F.element_at("plurals", k))
    value = F.when(plural, F.array_join(forms, "\x00")).otherwise(C("msgstr"))
    live = entries.filter(~C("obsolete") & (~C("is_fuzzy") | C("is_header"))).select("path", key.alias("key"), value.alias("value"), "pos")
    # one compiled file is one value, so its entries come together
    return live.filter(C("value") != "").groupBy("path").applyInPandas(pack, "path string, content binary")


def decoded(files: DataFrame) -> DataFrame:
    """path, key, value of compiled catalogues (path, content); a file of another format fails the query."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = ((path, k, v) for path, raw in zip(frame["path"], frame["content"], strict=True) for k, v in pairs(raw))
            yield from framed(rows, ["path", "key", "value"])

    return files.select("path", "content").mapInPandas(batches, "path string, key string, value string")
