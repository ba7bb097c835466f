"""Hand-written inputs and what they should give."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from orefold.functions import classify, ids
from orefold.functions import text as tx
from orefold.operators import graph, linking, metrics, sampling, validate
from pyspark.sql import functions as F


def one(spark, make, *values, kinds=None):
    names = [f"c{i}" for i in range(len(values))]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds or ["string"] * len(values)))
    return spark.createDataFrame([values], schema).select(make(*(F.col(n) for n in names)).alias("x")).first()["x"]


def test_content_hash_squeezes_and_folds(spark):
    want = "948a73256e9207e5496ea6117b87ba7cc78440cf450fb9b5bc2d1c67eb26fd30"
    assert one(spark, tx.content_hash, "Hello  World", "\tX\n") == want
    assert one(spark, tx.content_hash, "hello world", "x") == want


@pytest.mark.parametrize("text,pattern,want", [("b CVE-2024-1 a CVE-2023-9 CVE-2024-1", tx.CVE, "CVE-2023-9,CVE-2024-1"), ("none", tx.CVE, None), ("T1059.001 and T12345", tx.TECHNIQUE, "T1059.001,T1234")])
def test_identifiers(spark, text, pattern, want):
    assert one(spark, lambda c: tx.id_list(c, pattern), text) == want


@pytest.mark.parametrize("text,want", [("Severity: high", "HIGH"), ("Severity : low", "LOW"), ("Severity: bogus", None), ("", None)])
def test_severity(spark, text, want):
    assert one(spark, tx.severity, text) == want


@pytest.mark.parametrize("text,want", [("CVSS base score: 9.8 high", 9.8), ("base score: 9.", 9.0), ("base score: 9.8.", None), ("base score: 9.8.1", None), ("x", None)])
def test_cvss_score(spark, text, want):
    assert one(spark, tx.cvss_score, text) == want


def test_artifacts_html_and_sentences(spark):
    assert one(spark, tx.strip_artifacts, "> **Note** x\n* item") == "Note** x\nitem"
    assert one(spark, tx.strip_html, "a<br>b<ul><li>c</ul>") == "a\nb- c"
    assert one(spark, tx.first_sentence, "One two... Three.") == "One two"
    assert one(spark, tx.label, "command-and-control") == "Command And Control"
    assert one(spark, lambda c: tx.cut_at_sentence(c, 10), "One. Two. Three.") == "One. Two."
    assert one(spark, tx.strip_fences, "```json\n{}\n```") == "{}"


def test_predictions(spark):
    got = one(spark, tx.parse_prediction, "so\nT1059 | Execution | 87% | ps \nT1 | x | 1% | y")
    assert got.asDict() == {"technique_id": "T1059", "tactic": "Execution", "confidence": 87, "explanation": "ps"}
    assert one(spark, tx.parse_prediction, "nothing") is None
    assert one(spark, lambda c: tx.action_of(c, ["NONE", "UP", "DOWN", "LEFT", "RIGHT"]), "go up or left") == "LEFT"


@pytest.mark.parametrize("score,want", [(9.0, "CRITICAL"), (8.95, "HIGH"), (4.0, "MEDIUM"), (0.0, "LOW")])
def test_severity_of_score(spark, score, want):
    assert one(spark, tx.severity_of_score, score, kinds=["double"]) == want


@pytest.mark.parametrize("status,level,want", [("stable", "critical", 0), ("experimental", "low", 23), ("unknown", "unknown", 55)])
def test_rule_score(spark, status, level, want):
    assert one(spark, tx.rule_score, status, level) == want


def test_rules_keep_comments_and_last_values(spark):
    rule = "title: x\nstatus: test\ntags:\n    - attack.t1059.001\n    # note\n    - attack.T1003\nlevel: high\nstatus: stable\n"
    assert one(spark, tx.rule_techniques, rule) == ["T1059.001", "T1003"]
    assert one(spark, lambda c: tx.rule_field(c, "status", "experimental"), rule) == "stable"
    assert one(spark, lambda c: tx.rule_field(c, "author", "none"), rule) == "none"


def test_ids(spark):
    assert one(spark, ids.uuid5, "CVE-2024-3400") == "5b66111f-bd31-594e-a403-d5787f65253f"
    assert [one(spark, lambda c, n=n: ids.md5_choice(c, n), k) for k, n in (("APT28", 5), ("T1059.001", 3), ("Lazarus Group", 4))] == [4, 1, 1]


@pytest.mark.parametrize("p,want", [(0.90, "auto_alert"), (0.8999, "needs_verification"), (0.70, "needs_verification"), (0.39, "log_only")])
def test_alert_tiers(spark, p, want):
    assert one(spark, metrics.alert_tier, p, kinds=["double"]) == want


def test_domains_in_order(spark):
    prompts = ["Write a Sigma rule for x", "Write a Splunk SPL query for x", "Analyze the following log {}", "Who is the threat actor behind x", "Summarize CVE-2024-1", "Describe the technique T1059", "Is this code safe? ", "ExploitDB entry", "STIX bundle", "How is CVE-2020-1 mitigated", "Best practice"]
    want = ["sigma_rules", "siem_queries", "log_analysis", "apt_intel", "cve", "mitre_attack", "secure_code_review", "exploitdb", "stix_general", "cve", "security_general"]
    assert [one(spark, classify.domain, p, "") for p in prompts] == want


def test_validation(spark):
    rows = [
        (1, "cve", "q", " ", None, None, None, None, None, "other"),
        (2, "cve", "q", "x" * 60, "CVE-2024-1234", None, None, "HIGH", 9.1, "other"),
        (3, "cve", "q", "x" * 60, "CVE-2024-123", None, None, None, None, "other"),
        (4, "exploitdb", "q", "a", None, None, None, None, None, "other"),
        (5, "security_general", "q", "Yes.", None, None, None, None, None, "other"),
        (6, "cve", None, "x", None, None, None, None, None, "other"),
    ]
    df = spark.createDataFrame(rows, "id int, domain string, user_message string, assistant_message string, cve_ids string, mitre_techniques string, cwe_ids string, severity string, cvss_score double, question_type string")
    got = {r.id: (r.validation_status, [e.check for e in r.validation_errors]) for r in validate.validate(df).collect()}
    assert got[1] == ("fail", ["empty_assistant_message"])
    assert got[2] == ("warn", ["severity_cvss_mismatch"])
    assert got[3] == ("fail", ["cve_id_format"])
    assert got[4] == ("pass", [])
    assert got[5] == ("fail", ["response_too_short", "generic_filler"])
    assert got[6] == ("fail", ["empty_user_message"])


def test_ece_leaves_out_certainty_but_counts_it(spark):
    df = spark.createDataFrame([(1.0, 1)], "c double, y int")
    assert metrics.ece(df, "c", F.col("y")).first()["ece"] == 0
    assert metrics.reliability_bins(df, "c", F.col("y"), closed=True).first()["bin"] == 9


def test_positional_quantiles(spark):
    got = metrics.positional_quantiles(spark.createDataFrame([(float(i),) for i in (5, 1, 4, 2, 3)], "v double"), "v").first()
    assert (got.p25, got.median, got.p75) == (2, 3, 4)


def test_decision_points_start_each_episode(spark):
    df = spark.createDataFrame([(1, 0, "A"), (1, 1, "A"), (1, 2, "B"), (2, 0, "B")], "episode_id int, frame_index int, action_label string")
    got = {(r.episode_id, r.frame_index): r.is_decision for r in sampling.decision_points(df).collect()}
    assert [got[k] for k in sorted(got)] == [True, False, True, True]


def test_weights(spark):
    df = spark.createDataFrame([(i, "a", None) for i in range(13)] + [(100 + i, "b", 1.0) for i in range(10)], "id int, domain string, quality_score double")
    out = sampling.domain_weights(df, {"a": 0.08, "b": 2.5}).collect()
    assert sum(r.domain == "a" for r in out) == 1 and sum(r.domain == "b" for r in out) == 25


def test_links_prefer_the_first_strategy(spark):
    df = spark.createDataFrame([("s", 1, "detects", 1.0, 4), ("s", 1, "about", 0.8, 3)], "stix_id string, record_id int, link_type string, confidence double, strategy int")
    assert linking.first_links(df).first().asDict() == {"stix_id": "s", "record_id": 1, "link_type": "about", "confidence": 0.8, "strategy": 3}


def test_mentions_meet_whole_words_only(spark):
    texts = spark.createDataFrame([(1, "By APT28, twice"), (2, "APT289"), (3, "a lazarus GROUP op"), (4, "use C++ now"), (5, None)], "record_id int, text string")
    terms = spark.createDataFrame([("a", "apt28"), ("b", "Lazarus Group"), ("c", "C++x"), ("d", "++ n")], "stix_id string, term string")
    assert sorted((r.record_id, r.stix_id) for r in linking.mentions(texts, terms).collect()) == [(1, "a"), (3, "b")]


def test_reach_takes_the_shortest_path_and_counts_edges_per_end(spark):
    nodes = spark.createDataFrame([(x, "malware", x) for x in "ABC"] + [("V", "vulnerability", "V")], "stix_id string, type string, name string")
    edges = spark.createDataFrame([("A", "B", "uses"), ("B", "C", "uses"), ("A", "V", "uses")], "src string, dst string, rel_type string")
    g = graph.Graph(nodes, edges)
    assert {r.stix_id: r.depth for r in g.reach("A", 2).collect()} == {"A": 0, "B": 1, "C": 2}
    assert g.subgraph("A", 2, parity=True)[1].where("src = 'A' AND dst = 'B'").count() == 2
    assert g.subgraph("A", 2)[1].where("src = 'A' AND dst = 'B'").count() == 1


def test_checkpoints_of_equal_means(spark):
    """The same values in another order, or several times, are no better; a mean that is better by one bit is."""
    runs = {"order": [0.2, 0.3, 0.1] * 5, "bit": [0.2, 0.3, 0.1, 0.2, 0.3, 0.10000000000000042, 0.2], "gaps": [None, 0.1, 0.2, 0.3, None, 0.1], "all": [0.7, 0.1, float("inf"), 0.1, 0.1, 0.1]}
    df = spark.createDataFrame([(r, i, v) for r, values in runs.items() for i, v in enumerate(values)], "run string, seq int, v double")
    got = metrics.checkpoints(df, "run", "seq", "v", 1, last=3, least=3)
    assert sorted((r.run, r.seq) for r in got.collect()) == [("all", 2), ("bit", 2), ("bit", 5), ("gaps", 2), ("gaps", 3), ("gaps", 4), ("order", 2)]
    assert got.columns == ["run", "seq", "v", "mean_last", "max_last", "best_mean"]
    got = metrics.checkpoints(df.where("run = 'order'"), "run", "seq", "v", 3, last=9, least=3)
    assert [(r.seq, r.mean_last) for r in got.collect()] == [(2, 0.2)]


def test_means_rounded_once(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([0.1, -0.3, r.uniform(-1, 1) * 10.0 ** r.randint(-9, 9)]) for _ in range(r.randint(1, 100))]) for i in range(200)]
    df = spark.createDataFrame([*rows, (200, [])], "i int, v array<double>")
    got = {x.i: x.m for x in df.select("i", metrics.rounded_once(F.col("v")).alias("m")).collect()}
    assert got == {i: float(sum(map(Fraction, v)) / len(v)) for i, v in rows} | {200: None}
