"""Plural rules: a C expression over n as SQL, never evaluated as code."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*(\d+|n|&&|\|\||[<>=!]=|[-+*/%<>?:()!])")


class _Parser:
    """Precedence climbing over C operators; booleans and integers are told apart as they are built."""

    LEVELS = [["||"], ["&&"], ["==", "!="], ["<", ">", "<=", ">="], ["+", "-"], ["*", "/", "%"]]

    def __init__(self, text: str):
        self.tokens, at = [], 0
        text = text.strip().rstrip(";").strip()
        while at < len(text):
            match = _TOKEN.match(text, at)
            if not match:
                raise ValueError(f"not a plural rule: {text!r}")
            self.tokens.append(match.group(1))
            at = match.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def take(self, wanted: str | None = None) -> str:
        token = self.peek()
        if token is None or (wanted and token != wanted):
            raise ValueError(f"expected {wanted}, found {token}")
        self.at += 1
        return token

    def parse(self) -> str:
        out = _number(self.choice())
        if self.peek() is not None:
            raise ValueError(f"unexpected {self.peek()}")
        return out

    def choice(self) -> tuple[str, bool]:
        test = self.binary(0)
        if self.peek() != "?":
            return test
        self.take("?")
        yes = self.choice()
        self.take(":")
        no = self.choice()
        return f"CASE WHEN {_truth(test)} THEN {_number(yes)} ELSE {_number(no)} END", False

    def binary(self, level: int) -> tuple[str, bool]:
        if level == len(self.LEVELS):
            return self.unary()
        left = self.binary(level + 1)
        while self.peek() in self.LEVELS[level]:
            op, right = self.take(), self.binary(level + 1)
            if op in ("||", "&&"):
                left = (f"({_truth(left)} {'OR' if op == '||' else 'AND'} {_truth(right)})", True)
            elif op in ("+", "-", "*", "/", "%"):
                left = (f"({_number(left)} {'div' if op == '/' else op} {_number(right)})", False)
            else:
                left = (f"({_number(left)} {'=' if op == '==' else op} {_number(right)})", True)
        return left

    def unary(self) -> tuple[str, bool]:
        token = self.take()
        if token == "!":
            return f"(NOT {_truth(self.unary())})", True
        if token == "(":
            out = self.choice()
            self.take(")")
            return out
        if token == "n" or token.isdigit():
            return token, False
        raise ValueError(f"unexpected {token}")


def _truth(x: tuple[str, bool]) -> str:
    return x[0] if x[1] else f"({x[0]} <> 0)"


def _number(x: tuple[str, bool]) -> str:
    return f"CAST({x[0]} AS INT)" if x[1] else x[0]


def header_parts(header: str) -> tuple[int, str]:
    """nplurals and rule of a Plural-Forms value."""
    match = re.search(r"nplurals\s*=\s*(\d+)\s*;\s*plural\s*=\s*([^;]*)", header)
    if not match:
        raise ValueError(f"not a Plural-Forms value: {header!r}")
    return int(match.group(1)), match.group(2).strip()


def rule_sql(rule: str) -> str:
    """SQL over a column n."""
    return _Parser(rule).parse()


def form(rule: str) -> Column:
    return F.expr(rule_sql(rule)).cast("int")


def evaluated(numbers: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """numbers (with a column n) with locale and form for each of the rules."""
    forms = F.explode(F.array(*[F.struct(F.lit(name).alias("locale"), form(rule).alias("form")) for name, rule in rules]))
    return numbers.withColumn("_r", forms).select(*numbers.columns, "_r.locale", "_r.form")


def equivalent(spark: SparkSession, a: str, b: str, upto: int = 200) -> bool:
    """The two rules give equal forms for 0..upto."""
    return spark.range(upto + 1).withColumnRenamed("id", "n").filter(form(a) != form(b)).isEmpty()


def differing(spark: SparkSession, pairs: dict[str, tuple[str, str]], upto: int = 200) -> set[str]:
    """Names of the pairs of rules that give different forms for some n from 0 to upto; one job for all of them."""
    if not pairs:
        return set()
    tests = F.array_compact(F.array(*[F.when(form(a) != form(b), F.lit(name)) for name, (a, b) in pairs.items()]))
    rows = spark.range(upto + 1).withColumnRenamed("id", "n").select(F.explode(tests).alias("name")).distinct()
    return {r["name"] for r in rows.collect()}


def forms_fault(plurals: Column, nplurals: Column) -> Column:
    """True where the indices of a plural map are not 0 to nplurals - 1."""
    return F.array_sort(F.map_keys(plurals)) != F.sequence(F.lit(0), nplurals - 1)
