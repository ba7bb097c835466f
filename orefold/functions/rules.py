"""Conditions over named texts that render both as Columns and as SQL."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


class Condition:
    def column(self, texts: Mapping[str, Column]) -> Column:
        raise NotImplementedError

    def sql(self, texts: Mapping[str, str]) -> str:
        raise NotImplementedError

    def __and__(self, other: "Condition") -> "Condition":
        return Both(self, other, True)

    def __or__(self, other: "Condition") -> "Condition":
        return Both(self, other, False)


@dataclass(frozen=True)
class Both(Condition):
    left: Condition
    right: Condition
    all: bool

    def column(self, texts):
        a, b = self.left.column(texts), self.right.column(texts)
        return a & b if self.all else a | b

    def sql(self, texts):
        return f"({self.left.sql(texts)} {'AND' if self.all else 'OR'} {self.right.sql(texts)})"


@dataclass(frozen=True)
class Holds(Condition):
    """One of the words stands anywhere in the text."""

    text: str
    words: tuple[str, ...]

    def column(self, texts):
        return texts[self.text].rlike("|".join(re.escape(w) for w in self.words))

    def sql(self, texts):
        return "(" + " OR ".join(f"contains({texts[self.text]}, {quoted(w)})" for w in self.words) + ")"


@dataclass(frozen=True)
class Matches(Condition):
    text: str
    pattern: str

    def column(self, texts):
        return texts[self.text].rlike(self.pattern)

    def sql(self, texts):
        return f"regexp_matches({texts[self.text]}, {quoted(self.pattern)})"


def holds(text: str, *words: str) -> Holds:
    return Holds(text, words)


Cascade = Sequence[tuple[str, Condition]]


def first_match(cascade: Cascade, default: str, texts: Mapping[str, Column]) -> Column:
    """The name of the first condition that holds."""
    out = None
    for name, condition in cascade:
        out = F.when(condition.column(texts), name) if out is None else out.when(condition.column(texts), name)
    return out.otherwise(default)


def first_match_sql(cascade: Cascade, default: str, texts: Mapping[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {c.sql(texts)} THEN {quoted(n)}" for n, c in cascade) + f" ELSE {quoted(default)} END"
