"""Landed files, settings, a simulator that is busy, a relational file, subscriptions, and bounded lists."""

from __future__ import annotations

from dataclasses import dataclass, field

import pytest
from orefold.functions import ids
from orefold.operators import linking, sampling
from orefold.operators.graph import inverted_index
from orefold.sources import conversations, settings, simulator, sinks, sqlite
from orefold.sources.landing import land_file, new_folder, put
from orefold.streaming import metrics as live
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Inner:
    rate: float = 0.5
    on: bool = False


@dataclass(frozen=True)
class Outer:
    name: str = "x"
    kinds: tuple = ("a",)
    inner: Inner = field(default_factory=Inner)


def test_settings_over_typed_defaults():
    found = settings.parse("name: 'a: b' # c\n# x\nkinds:\n  - p\n  - q\ninner:\n  rate: 2\n  on: yes\nother: 1\n")
    assert found == {"name": "a: b", "kinds": "p,q", "inner.rate": "2", "inner.on": "yes", "other": "1"}
    assert settings.apply(Outer(), found) == Outer("a: b", ("p", "q"), Inner(2.0, True))


def test_a_busy_simulator_is_asked_again():
    asked = []

    def fetch(key, n):
        asked.append(n)
        if key == "none":
            raise simulator.Unknown(key)
        if n < 2 or key == "never":
            raise simulator.Busy(key)
        return [{"a": 1}]

    assert simulator.attempt(fetch, "k", (0, 0)) == [{"a": 1}] and asked == [0, 1, 2]
    assert simulator.attempt(fetch, "none", (0, 0)) == [] and simulator.attempt(fetch, "never", (0, 0)) == []


def test_relational_file_in_ranges(spark):
    path = sqlite.land(spark, f"{new_folder(spark)}/x.db", "a b", ("k", "v"), [(i, f"v{i}") for i in range(103)])
    for parts in (1, 4, 200):
        assert sorted(r.k for r in sqlite.read(spark, path, "a b", "k long, v string", parts).collect()) == list(range(103))
    assert sqlite.read(spark, sqlite.land(spark, f"{new_folder(spark)}/y.db", "t", ("k",), []), "t", "k long").count() == 0


def test_datasets_are_found_or_missed(spark):
    folder = new_folder(spark)
    put(spark, f"{folder}/x.txt", "x")
    with pytest.raises(FileNotFoundError):
        conversations.read_dataset(spark, None, folder)
    df = spark.range(1000).select(F.col("id").cast("string").alias("text"))
    df.write.parquet(f"{folder}/dataset")
    assert conversations.read_dataset(spark, None, folder).count() == 1000
    train, held = conversations.read_splits(spark, f"{folder}/dataset")
    assert train.count() + held.count() == 1000 and train.join(held, "text").isEmpty() and 50 < held.count() < 150
    df.limit(3).write.parquet(f"{folder}/dataset2/train")
    df.limit(2).write.parquet(f"{folder}/dataset2/test")
    assert [x.count() for x in conversations.read_splits(spark, f"{folder}/dataset2")] == [3, 2]


def test_a_subscriber_that_fails_stops_alone_and_ends_when_done(spark):
    folder, seen = new_folder(spark), []
    events = spark.createDataFrame([("r", i, "end" if i == 5 else "metrics", None, 0, float(i)) for i in range(10)], live.EVENTS)
    for i in range(0, 10, 2):
        land_file(events.where(f"seq >= {i} AND seq < {i + 2}").select(F.to_json(F.struct(*events.columns))), f"{folder}/in/{i}.json")
    stream = live.read_events(spark, f"{folder}/in", per_trigger=1)
    live.replay_then_tail(events.limit(1), stream, lambda b, n: seen.append((n, b.count())), f"{folder}/ck", done="event = 'end'")
    assert seen[0] == (-1, 1) and sum(n for k, n in seen[1:]) <= 10 and len(seen) >= 4

    def broken(batch, number):
        raise OSError("gone")

    with pytest.raises(Exception):
        live.replay_then_tail(events.limit(0), live.read_events(spark, f"{folder}/in"), lambda b, n: broken(b, n) if n >= 0 else None, f"{folder}/ck2")
    live.replay_then_tail(events.limit(0), live.read_events(spark, f"{folder}/in"), live.quietly(broken), f"{folder}/ck3")


def test_rotation_keeps_the_newest(spark):
    folder = new_folder(spark)
    assert sinks.rotate(spark, put(spark, f"{folder}/x", "") and folder, "1", 2) == []
    for i in "123":
        spark.range(1).write.parquet(f"{folder}/train")
        kept = sinks.rotate(spark, folder, i, 2)
    assert kept == ["backup_3", "backup_2"]


def test_insert_positions_and_inverted_index(spark):
    df = spark.createDataFrame([(i, [], f"k{i % 2}", f"n{i:02d}") for i in range(20)], "i int, a array<string>, k string, v string")
    assert {tuple(r[0]) for r in df.select(ids.insert_at(F.col("a"), F.lit("x"), F.col("v"))).collect()} == {("x",)}
    got = {r.key: (r.n, r.few) for r in inverted_index(df, "k", "v", 2, 3).collect()}
    assert got == {"k0": (10, ["n00", "n02", "n04"]), "k1": (10, ["n01", "n03", "n05"])}


def test_episode_split_takes_a_prefix_in_hash_order(spark):
    frames = spark.range(3000).select((F.col("id") % 97).alias("episode_id"), F.col("id").alias("frame_index"))
    rows = {r.episode_id: r.split for r in sampling.episode_split(frames, 0.2).select("episode_id", "split").distinct().collect()}
    order = [r.episode_id for r in spark.range(97).select(F.col("id").alias("episode_id")).orderBy(ids.order_key(F.col("episode_id"))).collect()]
    n, want = 0, {}
    for e in order:
        want[e] = "test" if n < 600 else "train"
        n += len(range(e, 3000, 97))
    assert rows == want


def test_names_with_odd_edges(spark):
    texts = spark.createDataFrame([(1, "see a?foo now"), (2, "foo"), (3, "x!!!!y"), (4, "call foo? bar")], "record_id int, text string")
    terms = spark.createDataFrame([("a", "?foo"), ("b", "!!!!"), ("c", "foo?"), ("d", "foo? bar")], "stix_id string, term string")
    assert sorted(tuple(r) for r in linking.mentions(texts, terms).collect()) == [(1, "a"), (3, "b"), (4, "d")]
