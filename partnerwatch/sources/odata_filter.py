"""OData ``$filter`` text as a column over landed records.

Grammar: ``or``, ``and``, ``not``, brackets; ``eq ne gt ge lt le``; the functions
``startswith``, ``endswith``, ``substringof``, ``tolower``, ``toupper``,
``length``; literals ``'text'`` (a quote is doubled), numbers (also with the
suffixes M, L, D, F), ``datetime'...'``, ``true``, ``false``, ``null``.

A comparison is true or false, never NULL: with a missing value ``ne`` is true and
all others are false. A property met with a number is read as one, leniently; one
met with a datetime is read from ``/Date(ms)/`` text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from partnerwatch.functions.scalar import lenient_double, parse_epoch_date

_TOKEN = re.compile(r"\s*(?:(?P<datetime>datetime'[^']*')|(?P<text>'(?:[^']|'')*')|(?P<number>-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?[MmLlDdFf]?)"
                    r"|(?P<name>[A-Za-z_][\w/]*)|(?P<mark>[(),]))")
_COMPARE = {"eq": "__eq__", "ne": "__ne__", "gt": "__gt__", "ge": "__ge__", "lt": "__lt__", "le": "__le__"}
_FUNCTIONS = {"startswith": 2, "endswith": 2, "substringof": 2, "tolower": 1, "toupper": 1, "length": 1}


class FilterError(ValueError):
    """The text is no filter over the columns."""


class _Filter:
    def __init__(self, text: str, columns: Sequence[str]) -> None:
        self.tokens, self.columns, self.at, pos = [], {c: c for c in columns}, 0, 0
        text = text.rstrip()
        while pos < len(text):
            m = _TOKEN.match(text, pos)
            if not m:
                raise FilterError(f"unexpected {text[pos:pos + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            pos = m.end()

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def accept(self, *wanted: str) -> str | None:
        kind, value = self.peek()
        if value in wanted and kind in ("name", "mark"):
            self.at += 1
            return value
        return None

    def need(self, mark: str) -> None:
        if not self.accept(mark):
            raise FilterError(f"{mark!r} expected before {self.peek()[1]!r}")

    def whole(self) -> Column:
        out = self.any_of()
        if self.peek()[0] != "end":
            raise FilterError(f"unexpected {self.peek()[1]!r}")
        return out

    def any_of(self) -> Column:
        out = self.all_of()
        while self.accept("or"):
            out = out | self.all_of()
        return out

    def all_of(self) -> Column:
        out = self.one()
        while self.accept("and"):
            out = out & self.one()
        return out

    def one(self) -> Column:
        if self.accept("not"):
            return ~self.one()
        if self.accept("("):
            out = self.any_of()
            self.need(")")
            return out
        kind, left = self.value()
        op = self.accept(*_COMPARE)
        if op:
            return _compared(op, (kind, left), self.value())
        if kind != "boolean":
            raise FilterError(f"a comparison expected before {self.peek()[1]!r}")
        return F.coalesce(left, F.lit(False))

    def value(self) -> tuple[str, Column]:
        kind, text = self.peek()
        self.at += 1
        if kind == "text":
            return "text", F.lit(text[1:-1].replace("''", "'"))
        if kind == "number":
            return "number", F.lit(float(text.rstrip("MmLlDdFf")))
        if kind == "datetime":
            return "datetime", F.lit(text[9:-1]).try_cast("timestamp")
        if kind == "name" and text in ("true", "false"):
            return "boolean", F.lit(text == "true")
        if kind == "name" and text == "null":
            return "null", F.lit(None)
        if kind == "name" and text in _FUNCTIONS and self.accept("("):
            args = [self.value()[1].cast("string")]
            while self.accept(","):
                args.append(self.value()[1].cast("string"))
            self.need(")")
            if len(args) != _FUNCTIONS[text]:
                raise FilterError(f"{text} takes {_FUNCTIONS[text]} values")
            return _called(text, args)
        if kind == "name" and text in self.columns:
            return "property", F.col(f"`{text}`")
        raise FilterError(f"unknown {text!r}")


def _called(name: str, args: list[Column]) -> tuple[str, Column]:
    if name == "startswith":
        return "boolean", args[0].startswith(args[1])
    if name == "endswith":
        return "boolean", args[0].endswith(args[1])
    if name == "substringof":  # the part comes first
        return "boolean", args[1].contains(args[0])
    if name == "length":
        return "number", F.length(args[0]).cast("double")
    return "text", F.lower(args[0]) if name == "tolower" else F.upper(args[0])


def _compared(op: str, left: tuple[str, Column], right: tuple[str, Column]) -> Column:
    kinds = {left[0], right[0]} - {"property"}
    if "null" in kinds:
        other = right[1] if left[0] == "null" else left[1]
        if op not in ("eq", "ne"):
            return F.lit(False)
        return other.isNull() if op == "eq" else other.isNotNull()
    if len(kinds) > 1:
        raise FilterError(f"{' and '.join(sorted(kinds))} cannot be compared")
    read = {"number": lenient_double, "datetime": _time, "text": lambda c: c.cast("string"), "boolean": lambda c: c.cast("boolean")}
    x, y = (read[next(iter(kinds))](c) if k == "property" and kinds else c for k, c in (left, right))
    return F.coalesce(getattr(x, _COMPARE[op])(y), F.lit(op == "ne"))


def _time(c: Column) -> Column:
    """Text of the service (``/Date(ms)/``) or of a date, as a timestamp."""
    return F.coalesce(parse_epoch_date(c.cast("string")), c.cast("string").try_cast("timestamp"))


def filter_column(text: str, columns: Sequence[str]) -> Column:
    """The condition that ``text`` states over ``columns``; ``FilterError`` if it
    is none."""
    return _Filter(text, columns).whole()
