"""Deterministic ids and choices: name-based UUIDs, hashed template choice, stable buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the URL namespace of name-based UUIDs, without hyphens.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column) -> Column:
    """The version 5 UUID of a name in the URL namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, 1)
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def md5_choice(key: Column, n: int) -> Column:
    """The 128-bit MD5 of key modulo n."""
    digest = F.md5(key.cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") % n
    return ((half(1) * ((1 << 64) % n) + half(17)) % n).cast("int")


def template(key: Column, templates: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, templates)), md5_choice(key, len(templates)) + 1)


def bucket(key: Column, n: int, seed: int = 42) -> Column:
    """A stable bucket of a key, the same under any partitioning."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary")), 1, 12), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def order_key(key: Column, seed: int = 42) -> Column:
    """A seeded order that looks random and does not depend on partitions."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def insert_at(values: Column, value: Column, key: Column) -> Column:
    """values with value put at a place chosen by the hash of key, before the first to behind the last."""
    digest = F.md5(key.cast("binary"))
    n = (F.size(values) + 1).cast("decimal(20,0)")
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") % n
    shift = F.lit(str(1 << 64)).cast("decimal(20,0)") % n
    place = ((half(1) * shift + half(17)) % n).cast("int")
    return F.array_insert(values, place + 1, value)


def seeded_choice(key: Column, templates: list[str], seed: int = 42) -> Column:
    """A template that looks drawn at random, the same for a key and seed."""
    return F.element_at(F.array(*map(F.lit, templates)), bucket(key, len(templates), seed) + 1)


def template_of_context(key: Column, reward: Column, turned: Column, big: list[str], turn: list[str], plain: list[str], seed: int = 42) -> Column:
    """A template by what happens: a reward over 100, a turn, else a plain step."""
    return F.when(reward > 100, seeded_choice(key, big, seed)).when(turned, seeded_choice(key, turn, seed)).otherwise(seeded_choice(key, plain, seed))
