"""Queries that take whole tables, against brute force over the driver's smallest tables."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import __spark_entry__
from orefold.operators import linking
from orefold.operators.graph import KILL_CHAIN
from orefold.plans import graph_queries
from orefold.plans.views import view

SF = "/root/testdata/sf0.001"


def rows(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


def run(spark, name: str) -> list[tuple]:
    return rows(__spark_entry__.queries()[name](spark, SF))


def test_all_actors_and_software_are_mentioned(spark):
    texts = [(r.record_id, r.text) for r in graph_queries._texts(spark, SF).collect()]
    nodes = graph_queries.load(spark, SF).nodes.collect()

    def brute(types: tuple) -> list[tuple]:
        terms = [(n.stix_id, re.compile(rf"\b{re.escape(x)}\b", re.I | re.A)) for n in nodes if n.type in types for x in {n.name, *n.aliases} if len(x) >= 4]
        return sorted({(k, s) for k, t in texts for s, p in terms if p.search(t)})

    got = run(spark, "J08_J09_mentions")
    assert got == brute(("intrusion-set",))
    assert {s for _, s in got} >= {f"intrusion-set--{i}" for i in range(150) if i in dict(texts)} and "intrusion-set--120" in {s for _, s in got}
    got = run(spark, "J16_mentions_of_software")
    assert got == brute(("malware", "tool")) and len(got) == 10


def test_mentions_of_long_terms(spark):
    texts = spark.createDataFrame([(1, "a b c d e f"), (2, "A-B c D"), (3, "a b c x"), (4, "a b")], "record_id int, text string")
    terms = spark.createDataFrame([("p", "b c d e"), ("q", "a-b C"), ("r", "a b"), ("s", "x")], "stix_id string, term string")
    assert rows(linking.mentions(texts, terms)) == [(1, "p"), (1, "r"), (2, "q"), (3, "r"), (3, "s"), (4, "r")]


def test_records_of_all_objects_and_objects_of_records(spark):
    records = graph_queries.records_with_ids(spark, SF)
    nodes = {r.stix_id: r for r in graph_queries.all_nodes(spark, SF).collect()}
    links = linking.link(records, graph_queries.all_nodes(spark, SF)).collect()
    domain = {r.id: r.domain for r in records.collect()}
    got = run(spark, "J01_records_of_objects")
    assert got == sorted((x.stix_id, x.record_id, domain[x.record_id], x.link_type) for x in links)
    assert {s.split("--")[0] for s, *_ in got} >= {"attack-pattern", "vulnerability"}
    got = run(spark, "J02_objects_of_records")
    assert got == sorted((x.record_id, x.stix_id, nodes[x.stix_id].type, nodes[x.stix_id].name, x.link_type, x.confidence) for x in links)


def test_shared_actors_of_all_techniques_and_techniques_of_all_campaigns(spark):
    uses, own = {}, {}
    for e in view(spark, SF, "v_edges").collect():
        if e.rel_type == "uses" and e.src.startswith("intrusion-set"):
            uses.setdefault(e.src, set()).add(e.dst)
        if e.rel_type == "attributed-to":
            own.setdefault(e.src, set()).add(e.dst)
    nodes = {r.stix_id: r for r in graph_queries.load(spark, SF).nodes.collect()}
    uses = {a: {t for t in ts if t in nodes and nodes[t].type == 'attack-pattern'} for a, ts in uses.items() if a in nodes}
    count = Counter(p for ts in uses.values() for p in itertools.combinations(sorted(ts), 2))
    got = run(spark, "J26_U04_shared_actors")
    assert got == sorted((*p, n) for p, n in count.items()) and any(a > "attack-pattern--2" for a, *_ in got)
    got = run(spark, "G18_G21_N13_O05_W12_campaign_techniques")
    want = []
    for c, actors in own.items():
        phase = lambda t: nodes[t].kill_chain_phases[0]
        used = sorted({t for a in actors for t in uses.get(a, ())}, key=lambda t: (KILL_CHAIN.index(phase(t)), t))
        want += [(c, t, nodes[t].name, phase(t), i) for i, t in enumerate(used, 1)]
    assert got == sorted(want) and len({c for c, *_ in got}) > 2


def test_rules_of_all_parts(spark, tmp_path):
    keys = [1, 7999, 8000, 9000, 19999]
    spark.createDataFrame([(k, k % 50) for k in keys], "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = rows(__spark_entry__.queries()["F24_F25_F26_rules"](spark, str(tmp_path)))
    assert [r[:2] for r in got] == [(k, f"T{1000 + k % 9000}") for k in keys]
