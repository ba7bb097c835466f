"""Quality rules: line-first cleaning, in DataFrame functions only.

Rules judge each line; failing lines go, and a document that loses too much of
its text goes with them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[ \\t-\\r]"
SYMBOLS = "#*$%&|<>"
#: Fixed phrases of page furniture, matched in lower case.
BOILERPLATE = (
    "all rights reserved|cookie policy|privacy policy|terms of (?:use|service)|use cookies|accept cookies|"
    "enable javascript|javascript is disabled|lorem ipsum|subscribe to our newsletter|sign up for|log in to|"
    "click here|read more|share this|follow us on|skip to content"
)


@dataclass(frozen=True)
class Rules:
    """A line fails if one of these holds; a document is kept if its failing lines hold at most max_lost of its characters."""

    max_symbol_share: float = 0.10  # symbols in its characters
    max_navigation_share: float = 0.25  # words that are separators: |, >, », ·, •, / or -
    min_navigation_words: int = 4
    max_boilerplate_words: int = 40  # longer lines are prose that may mention a phrase
    min_words_unpunctuated: int = 2  # fewer words, and no closing punctuation
    max_lost: float = 0.5
    min_words: int = 50
    max_repeat_percent: int = 50


def let(value: Column, body) -> Column:
    """body(value) with value computed once, where it is used inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def repeated_words(ws: Column) -> Column:
    """Words inside three-word windows that the array holds twice or more."""

    def covered(starts: Column) -> Column:
        following = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.lit(1 << 30)))
        runs = F.zip_with(starts, following, lambda a, b: F.least(b - a, F.lit(3)))
        return F.when(F.size(starts) == 0, 0).otherwise(F.aggregate(runs, F.lit(0), lambda x, y: x + y))

    def starts(ordered: Column) -> Column:
        gram = lambda i: F.get(ordered, i)["g"]
        hit = F.filter(ordered, lambda x, i: F.coalesce(x["g"] == gram(i - 1), F.lit(False)) | F.coalesce(x["g"] == gram(i + 1), F.lit(False)))
        return F.array_sort(F.transform(hit, lambda x: x["i"]))

    def grams(w: Column) -> Column:
        at = lambda i: F.get(w, i)
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))

    def repeats(found: Column) -> Column:
        numbered = F.sort_array(F.transform(found, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(let(numbered, lambda o: let(starts(o), covered)))

    return F.when(F.size(ws) < 3, F.lit(0)).otherwise(let(ws, lambda w: let(grams(w), repeats)))


def line_fails(line: Column, rules: Rules) -> Column:
    """Whether a line is furniture; lines without a word never fail."""

    def fails(text: Column, n_words: Column) -> Column:
        separators = F.size(F.filter(F.split(text, " "), lambda w: w.isin("|", ">", "»", "·", "•", "/", "-", "–", "::")))
        return (text != "") & (
            ((n_words < rules.min_words_unpunctuated) & ~text.rlike("[.!?:;…。！？\"')\\]]$"))
            | (text.rlike(f"[{SYMBOLS}]") & (F.regexp_count(text, F.lit(f"[{SYMBOLS}]")) > rules.max_symbol_share * F.length(text)))
            | ((n_words >= rules.min_navigation_words) & text.rlike("[|>»·•/–:-]") & (separators > rules.max_navigation_share * n_words))
            | ((n_words <= rules.max_boilerplate_words) & F.lower(text).rlike(BOILERPLATE))
        )

    return let(F.trim(F.regexp_replace(line, SPACE + "+", " ")), lambda text: let(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1, lambda n: fails(text, n)))


def clean(docs: DataFrame, text: str = "text", rules: Rules = Rules(), prefix: str = "") -> DataFrame:
    """docs with the measures n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_chars and cleaned_text.

    Columns of the same names are replaced; prefix keeps both.  A null or empty
    text has no words, fails the base rule and is not kept.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    name = lambda x: prefix + x
    measured = let(
        words(body),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).cast("long").alias("n_repeat_words")),
    )
    judged = let(
        F.transform(lines, lambda x: F.struct(x.alias("line"), line_fails(x, rules).alias("fails"))),
        lambda js: F.struct(
            F.array_join(F.transform(F.filter(js, lambda j: ~j["fails"]), lambda j: j["line"]), "\n").alias("cleaned_text"),
            F.aggregate(F.filter(js, lambda j: j["fails"]), F.lit(0), lambda a, j: a + F.length(F.regexp_replace(j["line"], SPACE + "+", ""))).alias("lost"),
        ),
    )
    out = docs.withColumns(
        {
            "__measured": measured,
            "__judged": judged,
            name("n_symbols"): F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).cast("long"),
            name("n_dup_lines"): let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        }
    )
    n, repeats = F.col("__measured.n_words"), F.col("__measured.n_repeat_words")
    failed = (n < rules.min_words) | (100 * repeats > rules.max_repeat_percent * n)
    lost = F.col("__judged.lost").cast("long")
    return out.withColumns(
        {
            name("n_words"): n,
            name("word_chars"): F.col("__measured.word_chars"),
            name("n_repeat_words"): repeats,
            name("base_failed"): failed,
            name("lost_chars"): lost,
            name("cleaned_text"): F.col("__judged.cleaned_text"),
            name("kept"): ~failed & (lost <= rules.max_lost * F.col("__measured.word_chars")),
        }
    ).drop("__measured", "__judged")
