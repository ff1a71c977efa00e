"""Message catalogues (.po) as a Spark data source, and back to text byte for byte.

    spark.dataSource.register(PoSource)
    spark.read.format("po").load("locale/*/LC_MESSAGES/messages.po")

A file is one partition; entries keep their place in `pos`.
"""

from __future__ import annotations

import glob
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .shared import framed

SCHEMA = (
    "locale string, module string, path string, pos int, raw string, sep string, msgctxt string, msgid string, msgid_plural string, msgstr string, "
    "plurals map<int,string>, locations array<string>, flags array<string>, comments array<string>, obsolete boolean, obsolete_msgid string, "
    "is_header boolean, is_fuzzy boolean, line_start int, line_end int"
)
_ESCAPES = (("\\n", "\n"), ("\\t", "\t"), ('\\"', '"'), ("\\\\", "\\"))
_KEYWORD = re.compile(r'^(msgctxt|msgid_plural|msgid|msgstr)(?:\[(\d+)\])?\s+"(.*)"\s*$')
_MORE = re.compile(r'^"(.*)"\s*$')


def unescape(text: str) -> str:
    for escaped, plain in _ESCAPES:
        text = text.replace(escaped, plain)
    return text


def unescape_once(text: str) -> str:
    """Each escape decoded once: the inverse of escape(), also where a backslash stands before n or t."""
    plain = dict(_ESCAPES)
    return re.sub(r'\\[nt"\\]', lambda m: plain[m.group()], text)


def escape(text: str) -> str:
    for escaped, plain in reversed(_ESCAPES):
        text = text.replace(plain, escaped)
    return text


@dataclass
class Entry:
    raw: str
    sep: str = ""
    fields: dict = field(default_factory=dict)
    plurals: dict = field(default_factory=dict)
    locations: list = field(default_factory=list)
    flags: list = field(default_factory=list)
    comments: list = field(default_factory=list)
    obsolete: bool = False
    obsolete_msgid: str | None = None
    line_start: int = 1


def blocks(text: str) -> Iterator[tuple[str, str]]:
    """(block, separator) pairs whose concatenation is the text; a separator is a run of empty lines."""
    at = 0
    for gap in re.finditer(r"\n(?:[ \t\r\f\v]*\n)+", text):
        yield text[at : gap.start()], gap.group()
        at = gap.end()
    if at < len(text):
        yield text[at:], ""


def split_blocks(text: str) -> list[tuple[str, str]]:
    return list(blocks(text))


def _quoted(lines: list[str], wanted: str, decode: Callable[[str], str]) -> str:
    """The joined string after a keyword and in the lines that go on."""
    parts, on = [], False
    for line in lines:
        match = _KEYWORD.match(line)
        if match:
            on = match.group(1) == wanted
            if on:
                parts.append(match.group(3))
        elif on and (more := _MORE.match(line)):
            parts.append(more.group(1))
    return decode("".join(parts))


def parse_block(raw: str, sep: str = "", decode: Callable[[str], str] = unescape) -> Entry:
    entry, lines = Entry(raw, sep), raw.split("\n")
    if any(x.startswith("#~") for x in lines) or not raw.strip():
        entry.obsolete = True
        entry.obsolete_msgid = _quoted([x[2:].strip() for x in lines if x.startswith("#~")], "msgid", decode) or None
        return entry
    current: tuple | None = None
    pieces: dict[tuple, list[str]] = {}
    for line in lines:
        if line.startswith("#:"):
            entry.locations += line[2:].split()
        elif line.startswith("#,"):
            entry.flags += [x.strip() for x in line[2:].split(",") if x.strip()]
        elif line.startswith("#"):
            entry.comments.append(line[1:].strip())
        elif match := _KEYWORD.match(line):
            current = (match.group(1), match.group(2))
            pieces.setdefault(current, []).append(match.group(3))
        elif current and (more := _MORE.match(line)):
            pieces[current].append(more.group(1))
    for (word, index), parts in pieces.items():
        value = decode("".join(parts))
        if index is not None:
            entry.plurals[int(index)] = value
        else:
            entry.fields[word] = value
    return entry


def entries_of(text: str, decode: Callable[[str], str] = unescape) -> Iterator[Entry]:
    """The entries of a text, one at a time."""
    line = 1
    for raw, sep in blocks(text):
        entry = parse_block(raw, sep, decode)
        entry.line_start = line
        line += (raw + sep).count("\n")
        yield entry


def parse(text: str, decode: Callable[[str], str] = unescape) -> list[Entry]:
    return list(entries_of(text, decode))


def as_text(word: str, value: str) -> str:
    """A keyword and its string; with line feeds inside, one line for each."""
    pieces = re.findall(r"[^\n]*\n|[^\n]+$", value)
    if len(pieces) > 1:
        return "\n".join([f'{word} ""', *(f'"{escape(p)}"' for p in pieces)])
    return f'{word} "{escape(value)}"'


def render(raw: str, sep: str, dirty: bool, msgstr: str | None, plurals: dict | None, flags: list[str] | None = None) -> str:
    """A block as text: as it was if not dirty, else its head with new strings, and new flags if given: where flags were, or else behind the places, or at the top."""
    if not dirty:
        return raw + (sep or "")
    head, place, flagged = [], 0, False
    for line in raw.split("\n"):
        if re.match(r"msgstr(?:\[\d+\])?\s", line):
            break
        if flags is not None and line.startswith("#,"):
            flagged, place = True, place if flagged else len(head)
            continue
        head.append(line)
        if line.startswith("#:") and not flagged:
            place = len(head)
    if flags:
        head.insert(place, "#, " + ", ".join(flags))
    if plurals:
        tail = [as_text(f"msgstr[{i}]", plurals[i]) for i in sorted(plurals)]
    else:
        tail = [as_text("msgstr", msgstr or "")]
    return "\n".join([*head, *tail]) + (sep or "")


def place(path: str) -> tuple[str, str | None]:
    """(locale, module) of a catalogue's path."""
    parts = os.path.normpath(path).split(os.sep)
    locale = parts[-3] if len(parts) > 2 and parts[-2] == "LC_MESSAGES" else (parts[-2] if len(parts) > 1 else "")
    module = parts[parts.index("Module") + 1] if "Module" in parts[:-1] else None
    return locale, module


def rows(path: str, text: str, decode: Callable[[str], str] = unescape) -> Iterator[tuple]:
    locale, module = place(path)
    seen_header = False
    for pos, e in enumerate(entries_of(text, decode)):
        msgid = e.fields.get("msgid", "")
        header = not e.obsolete and not seen_header and msgid == "" and "msgid" in e.fields
        seen_header = seen_header or header
        yield (
            locale, module, path, pos, e.raw, e.sep, e.fields.get("msgctxt"), msgid, e.fields.get("msgid_plural", ""), e.fields.get("msgstr", ""),
            e.plurals, e.locations, e.flags, e.comments, e.obsolete, e.obsolete_msgid, header, "fuzzy" in e.flags, e.line_start, e.line_start + e.raw.count("\n"),
        )


@dataclass
class PoFile(InputPartition):
    path: str


class PoReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[PoFile]:
        pattern = self.options.get("path", "")
        found = sorted(glob.glob(os.path.join(pattern, "**", "*.po*"), recursive=True) if os.path.isdir(pattern) else glob.glob(pattern, recursive=True))
        if not found:
            raise FileNotFoundError(pattern)
        return [PoFile(p) for p in found]

    def read(self, partition: PoFile) -> Iterator[tuple]:
        with open(partition.path, encoding="utf-8", newline="") as f:
            yield from rows(partition.path, f.read())


class PoSource(DataSource):
    """Catalogues on a file system that executors see; read_po() reads any store that Spark reads."""

    @classmethod
    def name(cls) -> str:
        return "po"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PoReader:
        return PoReader(self.options)


def read_po(spark: SparkSession, path: str, once: bool = False) -> DataFrame:
    """Catalogues through Spark's own file reader: path may be a glob and in any store. once: each escape is decoded once."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")

    def batches(frames):
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for frame in frames:
            for name, text in zip(frame["path"], frame["value"], strict=True):
                yield from framed(rows(name, text or "", unescape_once if once else unescape), names)

    return files.mapInPandas(batches, SCHEMA)


def catalogue_text(entries: DataFrame) -> DataFrame:
    """path, content: each catalogue as text. entries has path, pos, raw, sep, dirty, msgstr, plurals, flags."""

    @F.udf("string")
    def block(raw, sep, dirty, msgstr, plurals, flags):
        return render(raw, sep, bool(dirty), msgstr, plurals, flags)

    one = entries.select("path", "pos", block("raw", "sep", "dirty", "msgstr", "plurals", "flags").alias("text"))
    return one.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "").alias("content"))


def write_catalogues(entries: DataFrame, folder: str) -> None:
    """A new version of each catalogue in a folder of its own; nothing is overwritten."""
    catalogue_text(entries).write.mode("error").parquet(folder)


def views(entries: DataFrame) -> DataFrame:
    """locale, pos, form, src, dst of live entries: form -1 for singular, forms of a plural against msgid_plural; no empty texts, no echoes."""
    live = entries.filter(~F.col("obsolete") & ~F.col("is_header") & (F.col("msgid") != ""))
    forms = F.transform(F.map_entries("plurals"), lambda x: F.struct(x["key"].alias("form"), F.when(x["key"] == 0, F.col("msgid")).otherwise(F.col("msgid_plural")).alias("src"), x["value"].alias("dst")))
    single = F.array(F.struct(F.lit(-1).alias("form"), F.col("msgid").alias("src"), F.col("msgstr").alias("dst")))
    out = live.select("locale", "pos", F.explode(F.when(F.size("plurals") > 0, forms).otherwise(single)).alias("v")).select("locale", "pos", "v.*")
    return out.filter((F.col("dst") != "") & (F.col("dst") != F.col("src")))
