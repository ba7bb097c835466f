"""Queries over search-language functions and reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from orefold.functions import search
from orefold.operators import review
from orefold.operators.records import mean_review_score
from orefold.plans.text_queries import META, meta

Q, SQL = {}, {}


def add(name, sql=None):
    def keep(f):
        Q[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


_CRON = "CASE o_orderkey % 5 WHEN 0 THEN '*/' || CAST(o_custkey % 60 AS VARCHAR) || ' * * * *' WHEN 1 THEN CAST(o_custkey % 60 AS VARCHAR) || ' * * * *' WHEN 2 THEN '0 ' || CAST(o_custkey % 24 AS VARCHAR) || ' * * *' WHEN 3 THEN 'None' ELSE '5 4 1 * *' END"


@add("F29_schedules", f"SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'every ' || CAST(o_custkey % 60 AS VARCHAR) || ' minutes' WHEN 1 THEN 'every hour (at minute ' || CAST(o_custkey % 60 AS VARCHAR) || ')' WHEN 2 THEN 'daily at ' || CAST(o_custkey % 24 AS VARCHAR) || ':00' WHEN 4 THEN 'on cron schedule `5 4 1 * *`' END AS schedule FROM orders")
def _(spark, d):
    k = (F.col("o_orderkey") % 5).cast("int")
    n = lambda m: (F.col("o_custkey") % m).cast("string")
    cron = F.when(k == 0, F.concat(F.lit("*/"), n(60), F.lit(" * * * *"))).when(k == 1, F.concat(n(60), F.lit(" * * * *"))).when(k == 2, F.concat(F.lit("0 "), n(24), F.lit(" * * *"))).when(k == 3, "None").otherwise("5 4 1 * *")
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", search.schedule(cron).alias("schedule"))


_QUERY = "'index=main x=' || p_name || ' | stats count by host | where count > ' || CAST(p_size AS VARCHAR) || ' |search y | STATS z | `tool` a'"


def queries(spark, d):
    q = F.concat(F.lit("index=main x="), "p_name", F.lit(" | stats count by host | where count > "), F.col("p_size").cast("string"), F.lit(" |search y | STATS z | `tool` a"))
    t = F.when(F.col("p_size") % 3 == 0, "Brute force on vpn").when(F.col("p_size") % 3 == 1, "New service seen").otherwise("Odd " + "thing")
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_size", "p_name", t.alias("title"), q.alias("query"))


@add("F30_F31_hints", f"SELECT p_partkey, {search.hint_sql('t', 'q')} AS hint, 'Fw Log ' || CAST(p_size AS VARCHAR) AS source FROM (SELECT p_partkey, p_size, CASE p_size % 3 WHEN 0 THEN 'Brute force on vpn' WHEN 1 THEN 'New service seen' ELSE 'Odd thing' END AS t, {_QUERY} AS q FROM part)")
def _(spark, d):
    name = F.concat(F.lit("data/FW_log-"), F.col("p_size").cast("string"), F.lit(".csv"))
    return queries(spark, d).select("p_partkey", search.hint(F.col("title"), F.col("query")).alias("hint"), search.log_source(name).alias("source"))


@add("F32_F33_commands", "SELECT p_partkey, ['index=main', 'stats', 'where', 'tool'] AS commands, '1. **Base search:** `index=main x=' || p_name || '`' || chr(10) || '2. **`stats`:** " + search.COMMANDS["stats"] + "' || chr(10) || '3. **`where`:** " + search.COMMANDS["where"] + "' || chr(10) || '4. **`search`:** " + search.COMMANDS["search"] + "' || chr(10) || '5. **`STATS`:** Processes events with `STATS`' AS breakdown FROM part")
def _(spark, d):
    q = F.col("query")
    return queries(spark, d).select("p_partkey", search.commands(q).alias("commands"), search.breakdown(q).alias("breakdown"))


@add("F34_F35_explain")
def _(spark, d):
    return queries(spark, d).select("p_partkey", search.explain(F.col("title"), F.col("query")).alias("explanation"))


@add("X03_N16_review", META + "SELECT id, CAST(least(5, 1 + length(assistant_message) // 50) AS DOUBLE) AS score FROM r")
def _(spark, d):
    return review.review(meta(spark, d)).select("id", mean_review_score(F.col("quality_scores")).alias("score"))
