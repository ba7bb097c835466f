"""Invariants over the driver's smallest tables."""

from __future__ import annotations

import pytest
from orefold.operators import graph, linking, records, sampling, validate
from orefold.plans import graph_queries, text_queries
from orefold.plans.views import view
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    return text_queries.stored(spark, SF).cache()


def test_dedup_is_idempotent_and_keeps_the_first(stored):
    once = records.dedup_new(stored)
    twice = records.dedup_new(once)
    assert once.count() == twice.count() == stored.select("content_hash").distinct().count()
    first = stored.groupBy("content_hash").agg(F.min("id").alias("id"))
    assert once.join(first, ["content_hash", "id"], "left_anti").count() == 0
    assert records.dedup_new(stored, stored).count() == 0


def test_validation_states_sum_up(stored):
    v = validate.validate(stored)
    by = {r.name: r.n for r in validate.rollup(v).where("level = 'status'").collect()}
    assert sum(by.values()) == stored.count() and set(by) <= {"pass", "warn", "fail"}


def test_splits_are_disjoint_complete_and_stable(stored):
    ratios = {"train": 0.9, "validation": 0.05, "test": 0.05}
    a = {r.id: r.split for r in sampling.ratio_split(stored, "content_hash", ratios).select("id", "split").collect()}
    b = {r.id: r.split for r in sampling.ratio_split(stored.repartition(13), "content_hash", ratios).select("id", "split").collect()}
    assert a == b and len(a) == stored.count() and set(a.values()) == set(ratios)


def test_no_episode_is_in_both_splits(spark):
    out = sampling.episode_split(view(spark, SF, "v_frames"))
    assert out.groupBy("episode_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert {r.split for r in out.select("split").distinct().collect()} == {"train", "test"}


def test_links_are_unique_and_edges_have_ends(spark):
    nodes = graph_queries.all_nodes(spark, SF)
    links = linking.link(graph_queries.records_with_ids(spark, SF), nodes)
    assert links.count() == links.select("stix_id", "record_id").distinct().count() > 0
    g = graph_queries.load(spark, SF)
    extra = g.edges.limit(1).withColumn("dst", F.lit("nowhere"))
    assert graph.with_ends(g.edges.unionByName(extra), g.nodes).count() == g.edges.count()


def test_reach_is_minimal(spark):
    g = graph_queries.load(spark, SF)
    near = g.reach("campaign--1", 2)
    depth = {r.stix_id: r.depth for r in near.collect()}
    assert depth["campaign--1"] == 0
    direct = {r.dst for r in g.edges.where("src = 'campaign--1'").collect()} | {r.src for r in g.edges.where("dst = 'campaign--1'").collect()}
    assert {k for k, v in depth.items() if v == 1} == direct


def test_upsert_replaces_and_adds(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, o int")
    assert sorted(tuple(r) for r in records.upsert(old, new, "k", "o").collect()) == [(1, "a"), (2, "y"), (3, "z")]
