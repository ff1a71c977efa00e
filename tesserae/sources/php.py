"""Translatable strings of PHP sources: a tokenizer as a table function over Arrow batches of whole files.

Calls may span lines, strings may be joined with dots and hold escapes; what stands in comments, heredocs and outside of <?php ... ?> is no call.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

C = F.col
#: Functions that translate, with the positions of their singular and plural arguments.
CALLS = {"_": (0, None), "gettext": (0, None), "ngettext": (0, 1), "dgettext": (1, None), "dngettext": (1, 2)}
_TOKEN = re.compile(
    r"""(?P<comment>//[^\n]*?(?=\?>|\n|$)|\#(?!\[)[^\n]*?(?=\?>|\n|$)|/\*.*?(?:\*/|$))
    |(?P<doc><<<[ \t]*(?P<q>["']?)(?P<tag>[A-Za-z_]\w*)(?P=q)\r?\n.*?\n[ \t]*(?P=tag)\b)
    |(?P<single>'(?:[^'\\]|\\.)*')|(?P<double>"(?:[^"\\]|\\.)*")
    |(?P<close>\?>)|(?P<name>(?:->|::|\$|\\)?[A-Za-z_\x80-\uffff][\w\x80-\uffff]*)|(?P<mark>[()\[\]{},.])|(?P<other>[^\s])""",
    re.DOTALL | re.VERBOSE,
)
_OPEN = re.compile(r"<\?(?:php\b|=)?")
# Escapes of strings in double quotes.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "v": "\v", "e": "\x1b", "f": "\f", "\\": "\\", "$": "$", '"': '"'}
_ESCAPE = re.compile(r"\\(u\{[0-9A-Fa-f]+\}|x[0-9A-Fa-f]{1,2}|[0-7]{1,3}|.)", re.DOTALL)


def unquoted(token: str) -> str | None:
    """A string literal's value; None if it has a variable in it."""
    body = token[1:-1]
    if token[0] == "'":
        return re.sub(r"\\([\\'])", r"\1", body)
    if re.search(r"(?<!\\)(?:\\\\)*(?:\$[A-Za-z_{]|\{\$)", body):
        return None

    def plain(match: re.Match) -> str:
        e = match.group(1)
        if e[0] == "u" and len(e) > 1:
            return chr(int(e[2:-1], 16))
        if e[0] == "x" and len(e) > 1:
            return chr(int(e[1:], 16))
        return chr(int(e, 8) & 255) if e[0] in "01234567" else _ESCAPES.get(e, "\\" + e)

    return _ESCAPE.sub(plain, body)


def tokens(text: str) -> Iterator[tuple[str, str, int]]:
    """(kind, text, place) of the tokens of PHP parts, comments left out."""
    at = 0
    while found := _OPEN.search(text, at):
        at = found.end()
        while at < len(text) and (match := _TOKEN.search(text, at)):
            at = match.end()
            if match.lastgroup == "close" or match.group("close"):
                break
            kind = next(k for k in ("comment", "doc", "single", "double", "name", "mark", "other") if match.group(k) is not None)
            if kind != "comment":
                yield kind, match.group(kind), match.start()
        else:
            return


def calls(text: str) -> Iterator[tuple[str, str | None, int]]:
    """(msgid, msgid_plural, line) of the translating calls of a file whose arguments are literals, in order."""
    open_: list[dict] = []  # calls and other brackets that are open
    before = before2 = ("", "", 0)
    for kind, token, at in tokens(text):
        if kind == "mark" and token in "([{":
            called = before[1] if token == "(" and before[0] == "name" and before[1] in CALLS and before2[1] != "function" else None
            open_.append({"name": called, "at": before[2], "args": [[]]})
        elif kind == "mark" and token in ")]}" and open_:
            call = open_.pop()
            if call["name"]:
                one, several = CALLS[call["name"]]
                value = lambda k: "".join(call["args"][k]) if k is not None and k < len(call["args"]) and call["args"][k] and None not in call["args"][k] else None  # noqa: B023, E731
                if value(one):
                    yield value(one), value(several), text.count("\n", 0, call["at"]) + 1
            if open_:
                open_[-1]["args"][-1].append(None)
        elif open_ and kind == "mark" and token == ",":
            open_[-1]["args"].append([])
        elif open_ and not (kind == "mark" and token == "."):
            open_[-1]["args"][-1].append(unquoted(token) if kind in ("single", "double") else None)
        before2, before = before, (kind, token, at)


def translated_strings(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """path, msgid, msgid_plural, line of files, a whole text each. A null text has no calls; calls with variables among the literals are left out."""

    @F.arrow_udtf(returnType="path string, msgid string, msgid_plural string, line int")
    class Strings:
        def eval(self, table: pa.RecordBatch) -> Iterator[pa.Table]:
            rows = [(p, *c) for p, t in zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True) for c in calls(t or "")]
            names = [("path", pa.string()), ("msgid", pa.string()), ("msgid_plural", pa.string()), ("line", pa.int32())]
            yield pa.table([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(names)], names=[n for n, _ in names])

    return Strings(files.select(C(path).cast("string").alias("path"), C(text).cast("string").alias("text")).asTable())
