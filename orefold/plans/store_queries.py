"""Queries over sinks, stored tables, deterministic choices, idioms, and streams that are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orefold.functions import ids
from orefold.functions import text as tx
from orefold.operators import linking, metrics, records, review, sampling, validate
from orefold.plans import feed_reports
from orefold.plans.graph_queries import _VIEWS, load
from orefold.plans.report_queries import _LOGS, log_events
from orefold.plans.source_queries import _cat, _s, _table
from orefold.plans.text_queries import META, STORED, meta, stored
from orefold.plans.views import view, with_views
from orefold.sources import feeds, sinks
from orefold.sources.landing import new_folder, put
from orefold.streaming import metrics as live

Q, SQL = {}, {}


def add(name, sql=None):
    def keep(f):
        Q[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


# Stored records


@add("K02_K22_U05_hash_backfill", META + "SELECT min(id) AS id, content_hash FROM r GROUP BY content_hash")
def _(spark, d):
    """Hashes of all records in one pass; of records with one hash the first stays."""
    rows = view(spark, d, "v_records").withColumn("content_hash", tx.content_hash(F.col("user_message"), F.col("assistant_message")))
    return records.dedup_new(rows).select("id", "content_hash")


@add("K06_V11_validation_write_back", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'pass' ELSE 'old' END AS validation_status FROM orders")
def _(spark, d):
    k = F.col("id")
    old = _table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("old").alias("validation_status"))
    return records.write_back(old, old.where(k % 2 == 0).select("id", F.lit("pass").alias("validation_status")), "id", ["validation_status"])


@add("K10_K11_deletes", STORED + "SELECT id, 'record' AS kind FROM s WHERE NOT coalesce(domain = 'cve' AND validation_status = 'fail', false) UNION ALL SELECT id, 'link' FROM s WHERE NOT coalesce(domain = 'cve' AND validation_status = 'fail', false) AND id % 2 = 0")
def _(spark, d):
    """Records deleted by a predicate that is null for some, and the links of those that went."""
    s = stored(spark, d)
    kept = sinks.delete_where(s, "domain = 'cve' AND validation_status = 'fail'")
    links = sinks.delete_linked(s.where("id % 2 = 0").select(F.col("id").alias("record_id")), s.join(kept, "id", "left_anti"))
    return kept.select("id", F.lit("record").alias("kind")).unionByName(links.select(F.col("record_id").alias("id"), F.lit("link").alias("kind")))


@add("K12_K13_A30_A31_O04_exports", "SELECT 'never exported' AS name, CAST(count(*) AS VARCHAR) AS value FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT 'last export', '2024-02-01' UNION ALL SELECT 'counts', '{\"even\": ' || count(*) FILTER (WHERE o_orderkey % 6 = 0) || ', \"odd\": ' || count(*) FILTER (WHERE o_orderkey % 6 = 3) || '}' FROM orders UNION ALL SELECT 'records', CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderkey % 3 = 0")
def _(spark, d):
    """Exported records are stamped, two exports are added to the history, and the last one is read back."""
    folder, k = new_folder(spark), F.col("id")
    rows = _table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit(None).cast("timestamp").alias("exported_at"))
    out = rows.where(k % 3 == 0)
    stamped = sinks.stamp_exported(rows, out, "2024-02-01")
    counts = {r["g"]: r["n"] for r in out.groupBy(F.when(k % 2 == 0, "even").otherwise("odd").alias("g")).agg(F.count(F.lit(1)).alias("n")).collect()}
    for at, c in (("2024-01-01", {"even": 1}), ("2024-02-01", counts)):
        sinks.history_row(spark, at, c, {"even": 1.0}, folder).write.mode("append").json(f"{folder}/history")
    last = spark.read.json(f"{folder}/history").agg(F.max_by(F.struct("exported_at", "record_count", "domain_counts"), "exported_at").alias("h")).select("h.*")
    never = stamped.agg(F.count_if(F.col("exported_at").isNull()).alias("n")).select(F.lit("never exported").alias("name"), _s("n").alias("value"))
    return never.unionByName(last.select(F.explode(F.array(F.struct(F.lit("last export").alias("name"), F.col("exported_at").alias("value")), F.struct(F.lit("counts").alias("name"), F.col("domain_counts").alias("value")), F.struct(F.lit("records").alias("name"), _s("record_count").alias("value")))).alias("x")).select("x.*"))


@add("K14_K15_K16_K17_P23_P24_P25_message_exports", with_views("v_records") + "SELECT format, user_message, assistant_message || ' ü' AS assistant_message FROM v_records, (SELECT unnest(['jsonl', 'parquet']) AS format)")
def _(spark, d):
    """Two-turn records as JSON lines and as Parquet, read back."""
    from orefold.sources import conversations

    folder = new_folder(spark)
    rows = view(spark, d, "v_records").withColumn("assistant_message", F.concat("assistant_message", F.lit(" ü")))
    sinks.export_jsonl(rows, f"{folder}/x")
    sinks.export_parquet(rows, f"{folder}/y")
    back = conversations.pairs(conversations.read_jsonl(spark, f"{folder}/x")).select(F.lit("jsonl").alias("format"), "user_message", "assistant_message")
    m = F.col("messages")
    return back.unionByName(spark.read.parquet(f"{folder}/y/train").select(F.lit("parquet").alias("format"), m[0]["content"].alias("user_message"), m[1]["content"].alias("assistant_message")))


@add("K18_K19_U01_U10_K23_splits_and_manifest", "SELECT 'rows' AS name, count(*) AS n FROM (SELECT c_custkey FROM customer UNION ALL SELECT s_suppkey FROM supplier) UNION ALL SELECT 'repeated', 0 UNION ALL SELECT 'splits', 3 UNION ALL SELECT 'manifest', 3")
def _(spark, d):
    """Two sources joined, split in three, written with a manifest and read again: no row is lost or stands twice."""
    folder = new_folder(spark)
    both = _table(spark, d, "customer").select(_cat("c", _s("c_custkey")).alias("key")).unionByName(_table(spark, d, "supplier").select(_cat("s", _s("s_suppkey")).alias("key")))
    split = sampling.ratio_split(both, "key", {"train": 0.9, "validation": 0.05, "test": 0.05})
    counts = sinks.export_splits(split.select("key", "split"), f"{folder}/data")
    put(spark, f"{folder}/manifest.json", sinks.manifest(split, "split")[1:-1].replace("},{", "}\n{"))
    back, listed = spark.read.parquet(f"{folder}/data"), sinks.read_manifest(spark, f"{folder}/manifest.json")
    n = F.count(F.lit(1))
    agree = listed.where(F.col("n") == F.create_map(*(F.lit(x) for kv in counts.items() for x in kv))[F.col("split")])
    parts = [back.agg(n.alias("n")).select(F.lit("rows").alias("name"), "n"), back.agg((n - F.count_distinct("key")).alias("n")).select(F.lit("repeated").alias("name"), "n"), back.agg(F.count_distinct("split").alias("n")).select(F.lit("splits").alias("name"), "n"), agree.agg(n.alias("n")).select(F.lit("manifest").alias("name"), "n")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@add("K20_O11_backup_rotation", "SELECT unnest(['backup_20240104', 'backup_20240103', 'backup_20240102']) AS name, 25 AS n UNION ALL SELECT 'newest', 3")
def _(spark, d):
    """Splits move to a new backup four times; the newest three backups are kept, with their rows."""
    folder = new_folder(spark)
    for day in range(1, 5):
        _table(spark, d, "nation").write.parquet(f"{folder}/train")
        kept = sinks.rotate(spark, folder, f"2024010{day}", 3)
    out = None
    for name in kept:
        df = spark.read.parquet(f"{folder}/{name}/train").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = df if out is None else out.unionByName(df)
    files = spark.createDataFrame([("a", 1), ("c", 3), ("b", 2)], "file string, modified int")
    return out.unionByName(sinks.newest_file(files).select(F.lit("newest").alias("name"), F.when(F.col("file") == "c", 3).cast("long").alias("n")))


@add("K24_K27_S34_result_files", "SELECT r_name AS name, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name UNION ALL SELECT 'missing', 1")
def _(spark, d):
    """A small result as a JSON file, read again; a file that is not there is an error."""
    folder = new_folder(spark)
    counts = _table(spark, d, "region").join(_table(spark, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    back = sinks.read_manifest(spark, sinks.write_json(counts, f"{folder}/result.json")).select("name", "n")
    try:
        sinks.read_manifest(spark, f"{folder}/none.json")
        missing = 0
    except FileNotFoundError:
        missing = 1
    return back.unionByName(spark.createDataFrame([("missing", missing)], "name string, n long"))


@add("K21_J23_new_frames", "SELECT user_id AS episode_id, count(*) AS frames, count(*) FILTER (WHERE event_id % 5 <> 0) AS added FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_id % 5 <> 0) > 0")
def _(spark, d):
    """Frames whose hash the game has not stored are added, and the totals follow."""
    f = _table(spark, d, "events").select(F.col("user_id").alias("episode_id"), F.col("event_id").alias("id"), F.sha2(_s("event_id").cast("binary"), 256).alias("frame_hash"))
    old = f.where("id % 5 = 0")
    new = records.dedup_new(f, old, "frame_hash")
    total = old.unionByName(new).groupBy("episode_id").agg(F.count(F.lit(1)).alias("frames"))
    return total.join(new.groupBy("episode_id").agg(F.count(F.lit(1)).alias("added")), "episode_id")


# Filters, orders and groups


@add("P04_P19_O02_filters_and_orders", STORED + "SELECT id, 'best' AS kind, CAST(row_number() OVER (PARTITION BY domain ORDER BY quality_score DESC NULLS LAST, id) AS INT) AS place FROM s UNION ALL SELECT id, 'few', CAST(p AS INT) FROM (SELECT id, row_number() OVER (ORDER BY id) AS p FROM s WHERE domain = 'cve') WHERE p <= 20")
def _(spark, d):
    s = stored(spark, d)
    best = s.select("id", F.lit("best").alias("kind"), F.row_number().over(Window.partitionBy("domain").orderBy(F.desc_nulls_last("quality_score"), "id")).alias("place"))
    few = s.where("domain = 'cve'").orderBy("id").limit(20)
    return best.unionByName(few.select("id", F.lit("few").alias("kind"), F.row_number().over(Window.orderBy("id")).alias("place")))


@add("P18_token_gate", "SELECT doc_id, CAST(n AS INT) AS tokens FROM (SELECT doc_id, len(list_filter(string_split_regex(text, '[ \\t-\\r]+'), lambda w: w <> '')) AS n FROM documents WHERE text IS NOT NULL) WHERE n BETWEEN 50 AND 500")
def _(spark, d):
    n = F.size(F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != ""))
    return _table(spark, d, "documents").select("doc_id", n.alias("tokens")).where(F.col("tokens").between(50, 500))


@add("P09_X12_empty_descriptions", "SELECT p_partkey, 'some' AS which FROM part WHERE p_partkey % 3 <> 2 UNION ALL SELECT p_partkey, 'all' FROM part")
def _(spark, d):
    k = F.col("p_partkey")
    nodes = _table(spark, d, "part").select("p_partkey", F.when(k % 3 == 0, "").when(k % 3 == 2, F.col("p_name")).alias("description"))
    some = review.empty_descriptions(nodes).select("p_partkey", F.lit("some").alias("which"))
    return some.unionByName(review.empty_descriptions(nodes, True).select("p_partkey", F.lit("all").alias("which")))


@add("A06_O06_O09_O10_grouped_orders", STORED + "SELECT domain, count(*) AS n, array_to_string(list_slice(list(id ORDER BY id), 1, 5), ',') AS first, CAST(row_number() OVER (ORDER BY count(*) DESC, domain) AS INT) AS place FROM s GROUP BY domain")
def _(spark, d):
    """Records of each domain in their order, the first five of them, and the domains by their counts."""
    ranked = metrics.first_rows(stored(spark, d).select("id", "domain"), "domain", ["id"], 5)
    few = ranked.groupBy("domain").agg(F.array_join(F.transform(F.array_sort(F.collect_list("id")), lambda x: x.cast("string")), ",").alias("first"))
    n = stored(spark, d).groupBy("domain").agg(F.count(F.lit(1)).alias("n"))
    return n.join(few, "domain").withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "domain")))


@add("A29_generated_counters", _LOGS + "SELECT CASE WHEN k IN ('spl_query', 'kql_query', 'correlation_search') THEN 'siem_queries' WHEN k = 'sigma_write' THEN 'sigma_rules' ELSE 'log_analysis' END AS domain, count(*) AS n FROM (SELECT unnest(['log_analysis', 'triage', 'spl_query', 'kql_query', 'sigma_write']) AS k FROM l UNION ALL SELECT unnest(['log_correlation', 'correlation_search']) FROM m) GROUP BY 1")
def _(spark, d):
    pairs = feed_reports.log_pairs(log_events(spark, d))
    domain = F.when(F.col("kind").isin("spl_query", "kql_query", "correlation_search"), "siem_queries").when(F.col("kind") == "sigma_write", "sigma_rules").otherwise("log_analysis")
    return pairs.groupBy(domain.alias("domain")).agg(F.count(F.lit(1)).alias("n"))


@add("A32_S36_columns_of_tables", "SELECT column_name AS name FROM (DESCRIBE nation)")
def _(spark, d):
    """The columns of a stored table, as the catalog lists them."""
    _table(spark, d, "nation").createOrReplaceTempView("orefold_nation")
    return spark.createDataFrame([(c.name,) for c in spark.catalog.listColumns("orefold_nation")], "name string")


@add("J06_J24_technique_keys_and_mentions", _VIEWS + "SELECT attack_id AS tech, max(stix_id) AS stix_id, 'key' AS kind FROM n WHERE attack_id IS NOT NULL GROUP BY 1 UNION ALL SELECT 'CVE-' || (2000 + k % 26) || '-' || (1000 + k % 90), 'attack-pattern--' || k, 'mention' FROM (SELECT CAST(p_partkey AS INT) AS k FROM part)")
def _(spark, d):
    """Technique ids and the nodes that hold them; vulnerabilities that technique texts name."""
    nodes = load(spark, d).nodes
    keys = linking.technique_keys(nodes).select("tech", "stix_id", F.lit("key").alias("kind"))
    named = nodes.where("type = 'attack-pattern'").select(F.explode(F.array_distinct(F.regexp_extract_all("description", F.lit("(" + tx.CVE + ")"), F.lit(1)))).alias("tech"), "stix_id", F.lit("mention").alias("kind"))
    return keys.unionByName(named)


@add("V13_frame_checks", with_views("v_frames") + "SELECT 'action share' AS check, action_label AS key, count(*) / (SELECT count(*) FROM v_frames WHERE frame_index % 7 <> 3) AS value FROM v_frames WHERE frame_index % 7 <> 3 GROUP BY 2 HAVING count(*) > 0.2 * (SELECT count(*) FROM v_frames WHERE frame_index % 7 <> 3) UNION ALL SELECT 'missing frames', CAST(episode_id AS VARCHAR), CAST(max(frame_index) - min(frame_index) + 1 - count(*) AS DOUBLE) FROM v_frames WHERE frame_index % 7 <> 3 GROUP BY episode_id HAVING max(frame_index) - min(frame_index) + 1 > count(*)")
def _(spark, d):
    return validate.frame_checks(view(spark, d, "v_frames").where("frame_index % 7 <> 3"), most=0.2)


@add("W06_checkpoints", with_views("v_metrics") + "SELECT run_id, seq FROM (SELECT *, max(m) OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM (SELECT run_id, seq, avg(metric) OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS m, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS k FROM v_metrics) WHERE k % 3 = 0 AND k >= 4) WHERE best IS NULL OR m > best")
def _(spark, d):
    return metrics.checkpoints(view(spark, d, "v_metrics"), "run_id", "seq", "metric", 3, least=4).select("run_id", "seq")


@add("W13_until_limit", "SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k <= 100")
def _(spark, d):
    return metrics.first_rows(_table(spark, d, "lineitem"), "l_returnflag", ["l_orderkey", "l_linenumber"], 100).select("l_orderkey", "l_linenumber")


# Choices and idioms


def _choice_sql(key: str, n: int) -> str:
    return f"CAST(('0x' || md5({key}))::UHUGEINT % {n} AS INT)"


def _bucket_sql(key: str, n: int, seed: int = 42) -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 12))::UBIGINT % {n} AS INT)"


@add("U13_U14_U15_U16_U17_template_choices", f"SELECT o_orderkey, {_choice_sql("'CVE-' || o_orderkey", 3)} AS cve, {_choice_sql("'intrusion-set--' || o_custkey", 4)} AS groups, {_choice_sql("o_orderpriority", 2)} AS galaxy, {_choice_sql("'search ' || o_orderkey", 5)} AS spl, {_choice_sql("'T' || o_orderkey || o_orderstatus", 6)} AS logs FROM orders")
def _(spark, d):
    keys = {"cve": (_cat("CVE-", _s("o_orderkey")), 3), "groups": (_cat("intrusion-set--", _s("o_custkey")), 4), "galaxy": (F.col("o_orderpriority"), 2), "spl": (_cat("search ", _s("o_orderkey")), 5), "logs": (_cat("T", _s("o_orderkey"), F.col("o_orderstatus")), 6)}
    return _table(spark, d, "orders").select("o_orderkey", *(ids.md5_choice(k, n).alias(name) for name, (k, n) in keys.items()))


@add("U18_U20_context_templates", f"SELECT event_id, CASE WHEN value > 100 THEN ['big a', 'big b'][{_bucket_sql('event_id', 2)} + 1] WHEN event_id % 2 = 0 THEN ['turn a', 'turn b', 'turn c'][{_bucket_sql('event_id', 3)} + 1] ELSE ['plain a', 'plain b'][{_bucket_sql('event_id', 2)} + 1] END AS text FROM events")
def _(spark, d):
    k = F.col("event_id")
    return _table(spark, d, "events").select("event_id", ids.template_of_context(k, F.col("value"), k % 2 == 0, ["big a", "big b"], ["turn a", "turn b", "turn c"], ["plain a", "plain b"]).alias("text"))


@add("U19_insert_position", f"SELECT o_orderkey, CASE {_choice_sql("CAST(o_orderkey AS VARCHAR)", 4)} WHEN 0 THEN 'x,a,b,c' WHEN 1 THEN 'a,x,b,c' WHEN 2 THEN 'a,b,x,c' ELSE 'a,b,c,x' END AS listed FROM orders")
def _(spark, d):
    three = F.array(*map(F.lit, "abc"))
    return _table(spark, d, "orders").select("o_orderkey", F.array_join(ids.insert_at(three, F.lit("x"), _s("o_orderkey")), ",").alias("listed"))


@add("F13_F22_F23_F41_text_cleanup", "SELECT c_custkey, c_name || ' says' || chr(10) || 'yes' AS response, 'Command And Control ' || c_custkey AS label, '{\"a\": ' || c_custkey || '}' AS bare FROM customer")
def _(spark, d):
    raw = _cat("> ", F.col("c_name"), " says\n** yes\n ")
    return _table(spark, d, "customer").select("c_custkey", tx.postprocess_response(raw).alias("response"), tx.label(_cat("command-and-control ", _s("c_custkey"))).alias("label"), tx.strip_fences(_cat("```json\n{\"a\": ", _s("c_custkey"), "}\n```")).alias("bare"))


@add("N01_N19_N20_N21_N22_N23_idioms", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || ',x' ELSE '' END AS listed, CAST(o_orderdate AS DATE)::VARCHAR AS day, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS stamp, CASE WHEN (o_orderkey % 8) % 2 = 1 AND CAST(floor(o_orderkey % 8 / 2.0) AS INT) % 2 = 1 THEN floor(o_orderkey % 8 / 2.0) + 1 WHEN (o_orderkey % 8) % 2 = 1 THEN floor(o_orderkey % 8 / 2.0) ELSE o_orderkey % 8 / 2.0 END AS half_even, 'id=' || o_orderkey AS texts FROM orders")
def _(spark, d):
    """JSON lists, date prefixes, file-safe times, half-even rounding and the texts of a JSON object."""
    k = F.col("o_orderkey")
    cell = F.when(k % 3 == 0, F.to_json(F.array("o_orderpriority", F.lit("x")))).when(k % 3 == 1, "{bad")
    obj = _cat('{"id": "', _s(k), '", "list": [1], "none": null}')
    entries = F.transform(F.map_entries(tx.text_values(obj)), lambda e: _cat(e["key"], "=", e["value"]))
    at = F.col("o_orderdate").cast("timestamp")
    return _table(spark, d, "orders").select("o_orderkey", F.array_join(tx.listed_json(cell), ",").alias("listed"), tx.date_of(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")).alias("day"), tx.file_stamp(at).alias("stamp"), F.bround((k % 8).cast("double") / 2, 0).alias("half_even"), F.array_join(entries, ";").alias("texts"))


@add("N17_N18_X06_description_answers", "SELECT n_nationkey, 'id' || n_nationkey AS id, CASE WHEN n_nationkey % 3 = 0 THEN 'A description in JSON of ' ELSE 'A description as plain text of ' END || n_name || ' that is long enough to be kept.' AS description FROM nation WHERE n_nationkey % 3 <> 2")
def _(spark, d):
    """Answers as JSON arrays, as texts behind ids, and too short ones."""
    k, name = F.col("n_nationkey"), F.col("n_name")
    i = _cat("id", _s(k))
    listed = _cat('```json\n[{"id": "', i, '", "description": "A description in JSON of ', name, ' that is long enough to be kept."}]\n```')
    plain = _cat("### ", i, "\nA description as plain text of ", name, " that is long enough to be kept.\n")
    rows = _table(spark, d, "nation").select(k, i.alias("i"), F.when(k % 3 == 0, listed).when(k % 3 == 1, plain).otherwise(_cat("### ", i, "\nshort")).alias("answer"))
    return rows.select("n_nationkey", F.explode(review.descriptions_of(F.col("answer"), F.array("i"))).alias("x")).select("n_nationkey", "x.id", "x.description")


@add("G23_G24_G25_contexts", _VIEWS + """, d0 AS (SELECT p_partkey AS k, 'attack-pattern--' || p_partkey AS tech FROM part WHERE p_partkey % 50 = 1), few AS (SELECT d0.k, n.name AS technique, (SELECT array_to_string(list_slice(list_sort(list(DISTINCT a.name)), 1, 5), ', ') FROM e JOIN n a ON a.stix_id = src AND a.type = 'intrusion-set' WHERE dst = tech AND rel_type = 'uses') AS actors, (SELECT array_to_string(list_slice(list_sort(list(DISTINCT a.name)), 1, 5), ', ') FROM e JOIN n a ON a.stix_id = src AND a.type = 'course-of-action' WHERE dst = tech AND rel_type = 'mitigates') AS mitigations, (SELECT array_to_string(list_slice(list_sort(list(DISTINCT a.name)), 1, 5), ', ') FROM e JOIN n a ON a.stix_id = src AND a.type IN ('malware', 'tool') WHERE dst = tech AND rel_type = 'uses') AS software FROM d0 JOIN n ON n.stix_id = tech)
SELECT 'strategy--' || k AS stix_id, 'Technique: ' || technique || CASE WHEN actors IS NULL THEN '' ELSE chr(10) || 'Actors: ' || actors END || CASE WHEN mitigations IS NULL THEN '' ELSE chr(10) || 'Mitigations: ' || mitigations END || CASE WHEN software IS NULL THEN '' ELSE chr(10) || 'Software: ' || software END AS prompt FROM few""")
def _(spark, d):
    """Strategies that detect one technique each: its users, mitigations and programs as a prompt, alone and in batches."""
    from orefold.operators.graph import Graph

    g = load(spark, d)
    k = F.col("p_partkey")
    own = _table(spark, d, "part").where(k % 50 == 1).select(_cat("strategy--", _s(k)).alias("stix_id"), _cat("attack-pattern--", _s(k)).alias("dst"))
    nodes = g.nodes.unionByName(own.select("stix_id", F.lit("x-mitre-detection-strategy").alias("type"), F.col("stix_id").alias("name")), allowMissingColumns=True)
    g = Graph(nodes, g.edges.select("src", "dst", "rel_type").unionByName(own.select(F.col("stix_id").alias("src"), "dst", F.lit("detects").alias("rel_type"))))
    rows = review.contexts(g, own)
    batches = review.batch_prompts(rows)
    return batches.select(F.explode(F.split("prompt", "\n\n")).alias("p")).select(F.regexp_extract("p", r"^### (\S+)", 1).alias("stix_id"), F.regexp_replace("p", r"^### \S+\n", "").alias("prompt"))


@add("A37_evaluation_driver", "SELECT o_orderkey, 'T' || (1000 + o_orderkey % 5) AS truth, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'T9999' ELSE 'T' || (1000 + o_orderkey % 5) END AS pred FROM orders")
def _(spark, d):
    """Prompts to an injected predictor, in batches; answers that do not parse are missing."""
    n = F.col("o_orderkey")
    rows = _table(spark, d, "orders").select("o_orderkey", _cat("T", _s(1000 + n % 5)).alias("truth"), _s(n).alias("prompt"))

    def predict(prompts: list[str]) -> list[str | None]:
        out = []
        for p in prompts:
            k = int(p)
            out.append(None if k % 4 == 0 else f"T{9999 if k % 4 == 1 else 1000 + k % 5} | execution | 90% | seen")
        return out

    told = metrics.evaluate(rows, predict)
    return told.select("o_orderkey", "truth", tx.parse_prediction(F.col("answer"))["technique_id"].alias("pred"))


@add("X01_X02_X07_X09_row_functions", "SELECT doc_id, n, CAST(i AS INT) AS i FROM (SELECT doc_id, CAST(length(text) AS INT) AS n FROM documents WHERE length(text) % 2 = 0), (SELECT unnest([0, 1, 2]) AS i) WHERE i <= n % 3")
def _(spark, d):
    """A map, a filter and a one-to-many function over rows, as column expressions."""
    n = F.length("text")
    return _table(spark, d, "documents").select("doc_id", n.alias("n")).where(F.col("n") % 2 == 0).select("doc_id", "n", F.explode(F.sequence(F.lit(0), F.col("n") % 3)).alias("i"))


# Streams


def _events(spark, d) -> DataFrame:
    """The driver's events; sequence numbers are theirs."""
    e = _table(spark, d, "events")
    return e.select(_s("user_id").alias("run_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("event"), F.col("ts").cast("timestamp").alias("ts"), F.lit(0).alias("step"), F.col("value").alias("metric"))


def _landed(spark, d, folder: str, parts: int = 3) -> None:
    for i in range(parts):
        _events(spark, d).where(F.col("seq") % parts == i).coalesce(1).write.mode("append").json(f"{folder}/in")


@add("T03_T04_T06_T18_T25_replay_then_tail", "SELECT event_id AS seq, 'replay' AS kind FROM (SELECT event_id FROM events ORDER BY event_id DESC LIMIT 100) UNION ALL SELECT event_id, 'tail' FROM events UNION ALL SELECT event_id, 'again' FROM events WHERE event_id % 3 = 0")
def _(spark, d):
    """A subscriber gets the ring and then the stream; when it comes again it gets only what is new.  A second sink fails and is evicted quietly."""
    folder = new_folder(spark)
    _landed(spark, d, folder)
    first = live.ring(_events(spark, d), 100)
    kinds = {"now": "tail"}

    def deliver(batch: DataFrame, number: int) -> None:
        kind = "replay" if number < 0 else kinds["now"]
        batch.select("seq", F.lit(kind).alias("kind")).write.mode("overwrite").parquet(f"{folder}/out/{kinds['now']}{number}")

    def broken(batch: DataFrame, number: int) -> None:
        raise OSError("gone")

    both = live.fan_out(deliver, live.quietly(broken))
    stream = live.read_events(spark, f"{folder}/in", per_trigger=1)
    live.replay_then_tail(first, stream, both, f"{folder}/ck")
    kinds["now"] = "again"
    _events(spark, d).where("seq % 3 = 0").coalesce(1).write.mode("append").json(f"{folder}/in")
    live.replay_then_tail(first, live.read_events(spark, f"{folder}/in", per_trigger=1), both, f"{folder}/ck")
    return spark.read.parquet(f"{folder}/out/*")


@add("T10_T22_T23_T24_log_tail", "WITH l AS (SELECT n_regionkey AS job, n_nationkey AS seq, CASE WHEN n_nationkey = m AND n_regionkey <> 0 THEN CAST(n_regionkey % 2 AS INT) END AS code FROM nation JOIN (SELECT n_regionkey AS r, max(n_nationkey) AS m FROM nation GROUP BY 1) ON r = n_regionkey) SELECT 'job' || job AS job, CASE WHEN max(code) IS NULL THEN 'running' WHEN max(code) = 0 THEN 'finished' ELSE 'failed' END AS status, count(*) AS lines FROM l GROUP BY job")
def _(spark, d):
    """Log lines of jobs, tailed until the line that ends the last job has come; the status follows the exit codes."""
    folder = new_folder(spark)
    n, w = _table(spark, d, "nation"), Window.partitionBy("n_regionkey")
    last = F.col("n_nationkey") == F.max("n_nationkey").over(w)
    code = F.when(last & (F.col("n_regionkey") != 0), (F.col("n_regionkey") % 2).cast("int"))
    log = n.select(_cat("job", _s("n_regionkey")).alias("job"), F.col("n_nationkey").cast("long").alias("seq"), F.timestamp_seconds(F.col("n_nationkey")).alias("ts"), F.col("n_name").alias("line"), code.alias("code"))
    log.coalesce(1).write.json(f"{folder}/in/all")
    stop = spark.createDataFrame([("end", 10_000, None, "end", 0)], "job string, seq long, ts timestamp, line string, code int")
    stop.coalesce(1).write.json(f"{folder}/in/end")
    stream = spark.readStream.schema(stop.schema).json(f"{folder}/in/*")
    live.replay_then_tail(log.limit(0), stream, lambda b, i: b.write.mode("overwrite").parquet(f"{folder}/out/{i}"), f"{folder}/ck", done="job = 'end'")
    seen = spark.read.parquet(f"{folder}/out/*").where("job <> 'end'")
    return live.process_state(seen).select("job", "status", "lines")


@add("T17_T19_T21_T26_T27_events", "SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 'bench_step' ELSE 'eval' END AS event, CASE WHEN event_id % 2 = 0 AND event_id % 5 > 0 THEN value / (event_id % 5) END AS tokens_per_s, CASE WHEN event_id % 2 = 0 THEN value / 10 END AS memory_gb, CASE WHEN event_id % 2 = 1 THEN value END AS eval_loss FROM events")
def _(spark, d):
    k, v = F.col("event_id"), F.col("value")
    step = live.step_event(k, (k % 5).cast("double"), v, v / 10)
    ev = live.evaluation_event(k, v)
    e = _table(spark, d, "events").select(k.alias("seq"), F.when(k % 2 == 0, step).alias("s"), F.when(k % 2 == 1, ev).alias("e"))
    return e.select("seq", F.coalesce("s.event", "e.event").alias("event"), F.col("s.tokens_per_s"), F.col("s.memory_gb"), F.col("e.eval_loss"))


@add("T20_T21_lifecycle", "SELECT run_id, CASE WHEN e >= b THEN epoch(e) - epoch(b) END AS elapsed FROM (SELECT CAST(user_id AS VARCHAR) AS run_id, min(ts) FILTER (WHERE event_type = 'signup') AS b, max(ts) FILTER (WHERE event_type = 'error') AS e FROM events GROUP BY 1) WHERE b IS NOT NULL")
def _(spark, d):
    return live.lifecycle(_events(spark, d), "signup", "error").select("run_id", F.round("elapsed", 3).alias("elapsed"))


SQL["T20_T21_lifecycle"] = SQL["T20_T21_lifecycle"].replace("epoch(e) - epoch(b)", "round(epoch(e) - epoch(b), 3)")


@add("K25_K26_T18_metrics_log", "SELECT event_id AS seq, event_type AS event FROM events")
def _(spark, d):
    """A stream of events appended to a JSON log."""
    folder = new_folder(spark)
    _landed(spark, d, folder)
    live.read_events(spark, f"{folder}/in", per_trigger=1).writeStream.format("json").option("path", f"{folder}/log").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(live.EVENTS).json(f"{folder}/log").select("seq", "event")


@add("F37_F38_frame_images", "SELECT s_suppkey, array_to_string(list_transform(range(16), lambda j: substr('0123456789ABCDEF', 1 + CAST(CASE WHEN (s_suppkey * 7 + (4 * j + 0) * 13) % 5 > 2 THEN 8 ELSE 0 END + CASE WHEN (s_suppkey * 7 + (4 * j + 1) * 13) % 5 > 2 THEN 4 ELSE 0 END + CASE WHEN (s_suppkey * 7 + (4 * j + 2) * 13) % 5 > 2 THEN 2 ELSE 0 END + CASE WHEN (s_suppkey * 7 + (4 * j + 3) * 13) % 5 > 2 THEN 1 ELSE 0 END AS INT), 1)), '') AS frame_hash, 'true' AS same FROM supplier")
def _(spark, d):
    """Frames of 16 x 16 cells in two shades: their hashes, and their PNG chunks' sizes against the pixels."""
    from orefold.functions import images

    bit = lambda i: F.when((F.col("s_suppkey") * 7 + i * 13) % 5 > 2, 250).otherwise(5)
    gray = F.transform(F.sequence(F.lit(0), F.lit(255)), lambda p: bit(F.floor(p / 32) * 8 + F.floor((p % 16) / 2)))
    frames = _table(spark, d, "supplier").select("s_suppkey", images.pixmap(gray, 16, 16).alias("content"))
    out = images.as_png(images.hashed(frames))
    same = F.substring("png", 2, 3).cast("string") == "PNG"
    return out.select("s_suppkey", F.upper("frame_hash").alias("frame_hash"), same.cast("string").alias("same"))


@add("X04_X05_X11_X13_routed_reviews", META + "SELECT id, CASE WHEN domain = 'cve' THEN 'a' WHEN domain = 'sigma_rules' THEN 'b' ELSE 'default' END AS provider, CAST(CASE WHEN domain = 'cve' THEN 5 WHEN domain = 'sigma_rules' THEN 2 ELSE least(5, 1 + length(assistant_message) // 50) END AS DOUBLE) AS score FROM r")
def _(spark, d):
    """Records of two domains go to clients of their own, the others to the stub."""
    import json

    fixed = lambda n: lambda pairs: json.dumps([{x: n for x in review.DIMENSIONS}] * len(pairs))
    rows = meta(spark, d).withColumn("provider", F.when(F.col("domain") == "cve", "a").when(F.col("domain") == "sigma_rules", "b"))
    out = review.routed(rows, "provider", {"a": fixed(5), "b": fixed(2)}, review.stub)
    return out.select("id", "provider", records.mean_review_score(F.col("quality_scores")).alias("score"))


@add("J28_lookup_map", "SELECT s_suppkey, n_name AS nation FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def _(spark, d):
    """Names looked up in one map of a small table."""
    n = _table(spark, d, "nation").agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("names"))
    return _table(spark, d, "supplier").crossJoin(F.broadcast(n)).select("s_suppkey", F.try_element_at("names", F.col("s_nationkey")).alias("nation"))
