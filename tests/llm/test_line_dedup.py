"""Against exact distinct-site counts."""

from __future__ import annotations

from orefold.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"


def brute(rows, least=line_dedup.MIN_SITES):
    sites, first = {}, {}
    for d, t, s in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for i, line in enumerate((t or "").split("\n")):
            if k := line.strip(WHITE):
                sites.setdefault(k, set()).add(s)
                first.setdefault(k, (d, i))
    spread = {k for k, s in sites.items() if len(s) >= least}
    return {d: t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (k := x.strip(WHITE)) not in spread or first[k] == (d, i)) for d, t, _ in rows}


def test_spread_lines_go_but_for_the_first(spark):
    rows = [(i, f"own {i}\nshared by all \n\n\trare {i % 3}\nmid {i % 2}", f"s{i % 7}") for i in range(28)]
    rows += [(100, None, "s1"), (101, "", None), (102, " \n ", "s2"), (103, "shared by all", None), (104, "shared by all\nshared by all", "s1")]
    rows += [(200 + i, "null site line", None) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = line_dedup.dedup_lines(df)
    assert {r.doc_id: r.text for r in out.collect()} == brute(rows)
    assert {"n_lines", "n_removed"} < set(out.columns)


def test_empty_repeated_and_clashing_columns(spark):
    schema = "doc_id long, text string, source string, key string, line_no int, line_key binary"
    assert line_dedup.dedup_lines(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "x y", f"s{i}", "k", 1, b"") for i in range(6)] + [(1, "other\nx y", "s0", None, None, None), (None, "x y", "s9", None, None, None)]
    out = sorted((r.doc_id is not None, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, schema)).collect())
    assert len(out) == 8 and all("other" in t or t in ("", "x y") for _, t in out)


def test_many_sites_near_the_threshold(spark):
    rows = [(i, f"line {i % 10}", f"s{i // 10}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for least in (39, 40, 41):
        assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df, min_sites=least).collect()} == brute(rows, least)


def test_a_very_long_text(spark):
    long = "\n".join([*(f"own line {i}" for i in range(60_000)), "shared", *(f"later line {i}" for i in range(60_000)), "shared"])
    rows = [(1, long, "s1"), *((i, f"shared\nx {i}", f"s{i}") for i in range(2, 9))]
    out = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert {d: x[0] for d, x in out.items()} == brute(rows) and out[1][1:] == (120_002, 1)
