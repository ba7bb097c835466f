"""Against a plain re-computation."""

from __future__ import annotations

import re
from collections import Counter

from orefold.llm import quality_rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated), n < 50 or 100 * len(repeated) > 50 * n


CASES = [None, "", " \n\t", "one", "a b c a b c", "a a a a", "x y z\nx y z\n\nx y z", "é ü # | <b> $%&*", "w1 w2 w3 " * 40, "\x0b".join(f"v{i}" for i in range(60)), "same line.\n" * 30, "long " + "z" * 100_000]


def test_measures(spark):
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate([*CASES, CASES[4]])], "doc_id long, text string, n_words int")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.clean(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate([*CASES, CASES[4]])}
    assert quality_rules.clean(df.limit(0)).count() == 0


def test_lines(spark):
    prose = " ".join(f"Word{i}" for i in range(60)) + "."
    junk = " | ".join(f"Menu{i}" for i in range(40))
    symbols = " ".join(f"w{i}***" for i in range(60))
    rows = [(1, prose), (2, prose + "\n" + junk), (3, junk + "\n" + " ".join(f"a{i}" for i in range(20))), (4, symbols), (5, prose + "\nAll rights reserved")]
    got = {r.doc_id: (r.kept, r.cleaned_text) for r in quality_rules.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (True, prose) and got[2] == (True, prose) and got[5] == (True, prose)
    assert not got[3][0] and not got[4][0]
