"""Queries over the property graph, links, and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orefold.operators import graph, linking
from orefold.operators.graph import KILL_CHAIN, Graph
from orefold.plans.text_queries import META_SQL, meta
from orefold.plans.views import VIEWS, view
from orefold.sources.landing import new_folder

Q, SQL = {}, {}
_CHAIN = "[" + ", ".join(f"'{p}'" for p in KILL_CHAIN) + "]"
_VIEWS = f"""WITH v_nodes AS ({VIEWS['v_nodes']}), v_edges AS ({VIEWS['v_edges']}),
n AS (SELECT stix_id, type, name, CASE WHEN phase_no IS NULL THEN [] ELSE [({_CHAIN})[phase_no + 1]] END AS phases, CASE WHEN type = 'attack-pattern' AND CAST(split_part(stix_id, '--', 2) AS INT) < 700 THEN 'T' || CAST(1000 + CAST(split_part(stix_id, '--', 2) AS INT) AS VARCHAR(10)) END AS attack_id, CASE WHEN type = 'intrusion-set' THEN ['Group ' || split_part(stix_id, '--', 2), 'x' || split_part(stix_id, '--', 2)] ELSE [] END AS aliases FROM v_nodes),
e AS (SELECT src, dst, rel_type FROM v_edges), ut AS (SELECT DISTINCT src AS actor, dst AS tech FROM e JOIN n a ON a.stix_id = src AND a.type = 'intrusion-set' JOIN n t ON t.stix_id = dst AND t.type = 'attack-pattern' WHERE rel_type = 'uses') """
START = "campaign--3"


def add(name: str, sql: str | None = None, head: str = _VIEWS):
    def keep(f):
        Q[name] = f
        if sql is not None:
            SQL[name] = head + sql
        return f

    return keep


def load(spark: SparkSession, d: str) -> Graph:
    chain = F.array(*map(F.lit, KILL_CHAIN))
    key = F.substring_index("stix_id", "--", -1)
    nodes = view(spark, d, "v_nodes").select(
        "stix_id",
        "type",
        "name",
        F.when(F.col("phase_no").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.element_at(chain, F.col("phase_no") + 1))).alias("kill_chain_phases"),
        F.when((F.col("type") == "attack-pattern") & (key.cast("int") < 700), F.concat(F.lit("T"), (1000 + key.cast("int")).cast("string"))).alias("attack_id"),
        F.when(F.col("type") == "intrusion-set", F.array(F.concat(F.lit("Group "), key), F.concat(F.lit("x"), key))).otherwise(F.array().cast("array<string>")).alias("aliases"),
        F.when(F.col("type") == "attack-pattern", F.concat(F.lit("Seen with CVE-"), (2000 + key.cast("int") % 26).cast("string"), F.lit("-"), (1000 + key.cast("int") % 90).cast("string"), F.lit("."))).otherwise("").alias("description"),
    )
    return Graph(nodes, view(spark, d, "v_edges"))


def records_with_ids(spark: SparkSession, d: str) -> DataFrame:
    return meta(spark, d)


def all_nodes(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    """Graph nodes and the vulnerabilities that records name."""
    g = load(spark, d)
    rows = records_with_ids(spark, d) if rows is None else rows
    v = linking.vulnerability_nodes(rows.withColumn("quality_score", F.lit(None).cast("double")))
    return g.nodes.unionByName(v.select("stix_id", "type", "name"), allowMissingColumns=True)


def linked(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, nodes and links; records' metadata and nodes are made once."""
    rows = records_with_ids(spark, d).persist()
    nodes = all_nodes(spark, d, rows).persist()
    return rows, nodes, linking.link(rows, nodes)


@add("G01_name_index", "SELECT key, max(stix_id) AS stix_id FROM (SELECT lower(unnest([name] || aliases)) AS key, stix_id FROM n) GROUP BY key")
def _(spark, d):
    return load(spark, d).name_index()


@add("J20_node_by_name", "SELECT stix_id, name FROM n WHERE stix_id = (SELECT max(stix_id) FROM n WHERE list_contains(list_transform([name] || aliases, lambda x: lower(x)), 'group 17'))")
def _(spark, d):
    return load(spark, d).by_name("GROUP 17").select("stix_id", "name")


@add("G02_G08_relationships", "SELECT x.stix_id, direction, relationship_type, related_id, coalesce(n.name, '') AS related_name, coalesce(n.type, '') AS related_type FROM (SELECT src AS stix_id, 'outgoing' AS direction, rel_type AS relationship_type, dst AS related_id FROM e UNION ALL SELECT dst, 'incoming', rel_type, src FROM e) x LEFT JOIN n ON n.stix_id = related_id")
def _(spark, d):
    return load(spark, d).relationships()


_NEAR = "SELECT {near} AS stix_id, {far} AS other_id, o.name AS other_name, o.type AS other_type FROM e JOIN n o ON o.stix_id = {far} AND o.type IN ({types}) JOIN n s ON s.stix_id = {near} AND s.type = '{own}' WHERE rel_type = '{rel}'"


def _near(rel: str, types: str, own: str, incoming: bool = False) -> str:
    near, far = ("dst", "src") if incoming else ("src", "dst")
    return _NEAR.format(near=near, far=far, types=types, own=own, rel=rel)


@add("G03_G11_actor_techniques", _near("uses", "'attack-pattern'", "intrusion-set"))
def _(spark, d):
    return load(spark, d).actor_techniques()


@add("G12_software_techniques", _near("uses", "'attack-pattern'", "malware"))
def _(spark, d):
    return load(spark, d).neighbours("uses", "attack-pattern", source_type="malware")


@add("G04_G13_actor_campaigns", _near("attributed-to", "'campaign'", "intrusion-set", True))
def _(spark, d):
    return load(spark, d).actor_campaigns()


@add("G14_technique_actors", _near("uses", "'intrusion-set'", "attack-pattern", True))
def _(spark, d):
    return load(spark, d).technique_actors()


@add("G15_technique_mitigations", _near("mitigates", "'course-of-action'", "attack-pattern", True))
def _(spark, d):
    return load(spark, d).technique_mitigations()


@add("G16_technique_software", _near("uses", "'malware', 'tool'", "attack-pattern", True))
def _(spark, d):
    return load(spark, d).technique_software()


@add("G05_typed_path", "SELECT DISTINCT e1.src AS start, ut.tech AS stix_id FROM e e1 JOIN ut ON ut.actor = e1.dst WHERE e1.rel_type = 'attributed-to' AND e1.src LIKE 'campaign--%'")
def _(spark, d):
    g = load(spark, d)
    return g.path(g.of_type("campaign"), [("attributed-to", "intrusion-set"), ("uses", "attack-pattern")])


_REACH = f"""u AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e), r0 AS (SELECT '{START}' AS stix_id), r1 AS (SELECT DISTINCT b AS stix_id FROM u JOIN r0 ON a = stix_id), r2 AS (SELECT DISTINCT b AS stix_id FROM u JOIN r1 ON a = stix_id),
r AS (SELECT stix_id, min(depth) AS depth FROM (SELECT stix_id, 0 AS depth FROM r0 UNION ALL SELECT stix_id, 1 FROM r1 UNION ALL SELECT stix_id, 2 FROM r2) GROUP BY 1) """


@add("G06_reach", ", " + _REACH + "SELECT stix_id, depth FROM r")
def _(spark, d):
    return load(spark, d).stored(new_folder(spark)).reach(START, 2)


@add("G06_subgraph_edges", ", " + _REACH + "SELECT DISTINCT src, dst, rel_type FROM e WHERE src IN (SELECT stix_id FROM r WHERE depth < 2) OR dst IN (SELECT stix_id FROM r WHERE depth < 2)")
def _(spark, d):
    return load(spark, d).stored(new_folder(spark)).subgraph(START, 2)[1]


_PRUNED = _REACH + ", se AS (SELECT DISTINCT src, dst, rel_type FROM e WHERE src IN (SELECT stix_id FROM r WHERE depth < 2) OR dst IN (SELECT stix_id FROM r WHERE depth < 2)), dg AS (SELECT stix_id, count(*) AS degree FROM (SELECT src AS stix_id FROM se UNION ALL SELECT dst FROM se) GROUP BY 1), k AS (SELECT r.stix_id, depth FROM r LEFT JOIN dg USING (stix_id) ORDER BY r.stix_id = '" + START + "' DESC, depth, coalesce(degree, 0) DESC, r.stix_id LIMIT 50), ke AS (SELECT * FROM se WHERE src IN (SELECT stix_id FROM k) AND dst IN (SELECT stix_id FROM k)), kd AS (SELECT stix_id, count(*) AS degree FROM (SELECT src AS stix_id FROM ke UNION ALL SELECT dst FROM ke) GROUP BY 1) "


@add("G07_W11_A16_pruned_subgraph", ", " + _PRUNED + "SELECT k.stix_id, depth, coalesce(degree, 0) AS degree FROM k LEFT JOIN kd USING (stix_id)")
def _(spark, d):
    return load(spark, d).stored(new_folder(spark)).pruned_subgraph(START, 2, 50)[0].select("stix_id", "depth", "degree")


@add("A35_subgraph_histogram", ", " + _REACH + "SELECT type, count(*) AS n FROM r JOIN n USING (stix_id) GROUP BY type")
def _(spark, d):
    return load(spark, d).stored(new_folder(spark)).subgraph(START, 2)[0].groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@add("G09_F47_O07_search", "SELECT stix_id, type, name, score FROM (SELECT stix_id, CASE WHEN max(CAST(key = 'group 1' AS INT)) = 1 THEN 100 ELSE max(CASE WHEN starts_with(key, 'group 1') THEN 80 ELSE 50 END + greatest(0, 30 - length(key))) END AS score FROM (SELECT key, max(stix_id) AS stix_id FROM (SELECT lower(unnest([name] || aliases)) AS key, stix_id FROM n) GROUP BY key) WHERE contains(key, 'group 1') GROUP BY stix_id) JOIN n USING (stix_id) ORDER BY score DESC, stix_id LIMIT 20")
def _(spark, d):
    return load(spark, d).search("Group 1")


@add("G10_nodes_of_type", "SELECT stix_id, name FROM n WHERE type IN ('intrusion-set', 'course-of-action')")
def _(spark, d):
    return load(spark, d).of_type("intrusion-set", "course-of-action").select("stix_id", "name")


@add("O08_list_of_type", "SELECT stix_id, name FROM (SELECT stix_id, name FROM n WHERE type = 'malware' ORDER BY stix_id LIMIT 20)")
def _(spark, d):
    return load(spark, d).of_type("malware").orderBy("stix_id").limit(20).orderBy("name").select("stix_id", "name")


@add("A02_G19_A36_stats", "SELECT 'object' AS kind, type AS name, count(*) AS n FROM n GROUP BY type UNION ALL SELECT 'relationship', rel_type, count(*) FROM e GROUP BY rel_type")
def _(spark, d):
    return load(spark, d).stats()


@add("G17_G20_A15_campaigns", ", a AS (SELECT src AS stix_id, arg_min(o.name, dst) AS actor FROM e JOIN n o ON o.stix_id = dst AND o.type = 'intrusion-set' WHERE rel_type = 'attributed-to' GROUP BY 1) SELECT n.stix_id, n.name, actor, 0 AS technique_count, 0 AS malware_count, 0 AS tool_count FROM n LEFT JOIN a USING (stix_id) WHERE type = 'campaign'")
def _(spark, d):
    return load(spark, d).campaigns().drop("phases")


def _campaign_graph(spark, d) -> Graph:
    """The graph with actors' techniques given to their campaigns, as the driver's campaigns have none."""
    g = load(spark, d)
    own = g.path(g.of_type("campaign"), [("attributed-to", "intrusion-set"), ("uses", "attack-pattern")])
    return Graph(g.nodes, own.select(F.col("start").alias("src"), F.col("stix_id").alias("dst"), F.lit("uses").alias("rel_type")))


@add("G18_G21_N13_O05_W12_campaign_techniques", f", c AS (SELECT DISTINCT e1.src AS stix_id, ut.tech AS other_id FROM e e1 JOIN ut ON ut.actor = e1.dst WHERE e1.rel_type = 'attributed-to') SELECT c.stix_id, other_id, name AS other_name, phases[1] AS phase, CAST(row_number() OVER (PARTITION BY c.stix_id ORDER BY list_position({_CHAIN}, phases[1]), other_id) AS INT) AS position FROM c JOIN n ON n.stix_id = other_id")
def _(spark, d):
    return _campaign_graph(spark, d).campaign_techniques()


@add("N12_ordered_phases", f"SELECT actor, list_filter({_CHAIN}, lambda p: list_contains(ps, p)) AS phases FROM (SELECT actor, list(phases[1]) AS ps FROM ut JOIN n ON stix_id = tech GROUP BY actor)")
def _(spark, d):
    g = load(spark, d)
    used = g.actor_techniques().join(g.nodes.select(F.col("stix_id").alias("other_id"), "kill_chain_phases"), "other_id")
    ps = used.groupBy(F.col("stix_id").alias("actor")).agg(F.flatten(F.collect_set("kill_chain_phases")).alias("p"))
    return ps.select("actor", graph.ordered_phases(F.col("p")).alias("phases"))


@add("J26_U04_shared_actors", "SELECT x.tech AS a, y.tech AS b, count(*) AS n_actors FROM ut x JOIN ut y ON x.actor = y.actor AND x.tech < y.tech GROUP BY 1, 2")
def _(spark, d):
    return load(spark, d).shared_actors()


@add("J27_relational_division", ", w AS (SELECT actor AS grp, tech FROM (SELECT actor, tech, row_number() OVER (PARTITION BY actor ORDER BY tech) AS k FROM ut) WHERE k <= 2), z AS (SELECT grp, count(*) AS n FROM w GROUP BY 1) SELECT w.grp AS \"group\", ut.actor FROM w JOIN ut USING (tech) JOIN z ON z.grp = w.grp GROUP BY 1, 2, n HAVING count(*) = n")
def _(spark, d):
    g = load(spark, d)
    use = g.actor_techniques().select(F.col("stix_id").alias("group"), F.col("other_id").alias("tech")).distinct()
    two = use.withColumn("k", F.row_number().over(Window.partitionBy("group").orderBy("tech"))).where("k <= 2")
    return g.actors_of_all(two.select("group", "tech"))


_COVER = ", m AS (SELECT DISTINCT dst AS tech, src AS mitigation FROM e WHERE rel_type = 'mitigates')"


@add("A12_mitigation_coverage", _COVER + " SELECT * FROM (SELECT actor, mitigation, count(DISTINCT tech) AS covered, CAST(row_number() OVER (PARTITION BY actor ORDER BY count(DISTINCT tech) DESC, mitigation) AS INT) AS rank FROM ut JOIN m USING (tech) GROUP BY 1, 2) WHERE rank <= 3")
def _(spark, d):
    return load(spark, d).mitigation_coverage(3)


@add("A13_detection_coverage", " SELECT actor, count(*) AS total, count(*) FILTER (WHERE tech LIKE '%7') AS covered, CAST(floor(100 * count(*) FILTER (WHERE tech LIKE '%7') / count(*)) AS BIGINT) AS pct, CASE WHEN floor(100 * count(*) FILTER (WHERE tech LIKE '%7') / count(*)) < 50 THEN 'LOW' WHEN floor(100 * count(*) FILTER (WHERE tech LIKE '%7') / count(*)) < 80 THEN 'MODERATE' ELSE 'HIGH' END AS tier FROM ut GROUP BY actor")
def _(spark, d):
    g = load(spark, d)
    return g.detection_coverage(g.of_type("attack-pattern").where("stix_id LIKE '%7'"))


@add("G26_subtechniques", "SELECT dst AS parent, count(*) AS n, list_sort(list(name)) AS children FROM e JOIN n ON n.stix_id = src WHERE rel_type = 'subtechnique-of' GROUP BY dst HAVING count(*) >= 2")
def _(spark, d):
    return load(spark, d).subtechniques()


@add("A14_A34_tactic_counts", "SELECT * FROM (SELECT actor, phases[1] AS tactic, count(*) AS n, CAST(row_number() OVER (PARTITION BY actor ORDER BY count(*) DESC, phases[1]) AS INT) AS rank FROM ut JOIN n ON stix_id = tech GROUP BY 1, 2) WHERE rank <= 5")
def _(spark, d):
    return load(spark, d).tactic_counts()


@add("A07_techniques_by_tactic", "SELECT phases[1] AS tactic, count(*) AS n, min(name) AS first FROM n WHERE type = 'attack-pattern' GROUP BY 1")
def _(spark, d):
    t = load(spark, d).of_type("attack-pattern").select(F.explode("kill_chain_phases").alias("tactic"), "name")
    return t.groupBy("tactic").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first"))


@add("K04_J17_insert_edges", "SELECT min(seq) AS seq, relationship_id FROM (SELECT o_orderkey AS seq, 'r' || CAST(o_orderkey % 1000 AS VARCHAR(10)) AS relationship_id, 'intrusion-set--' || CAST(o_custkey * 2 AS VARCHAR(10)) AS src FROM orders) WHERE src IN (SELECT stix_id FROM n) GROUP BY relationship_id")
def _(spark, d):
    g = load(spark, d)
    text = lambda c: c.cast("string")
    new = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("seq"), F.concat(F.lit("r"), text(F.col("o_orderkey") % 1000)).alias("relationship_id"), F.concat(F.lit("intrusion-set--"), text(F.col("o_custkey") * 2)).alias("src"), F.lit("campaign--1").alias("dst"))
    return graph.insert_edges(None, new, g.nodes).select("seq", "relationship_id")


def _keys_sql(key: str, text: str, table: str) -> str:
    """Texts with each of their words and pairs of neighbouring words, lower case."""
    return f"SELECT {key}, t, unnest(list_distinct(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS key FROM (SELECT {key}, t, regexp_extract_all(lower(t), '[a-z0-9_]+') AS w FROM (SELECT {key}, {text} AS t FROM {table}))"


def _terms_sql(types: str, names: str) -> str:
    """Names of four characters or more with their first two words, or the only one."""
    return f"SELECT stix_id, term, w[1] || coalesce(' ' || w[2], '') AS key FROM (SELECT stix_id, term, regexp_extract_all(lower(term), '[a-z0-9_]+') AS w FROM (SELECT stix_id, unnest({names}) AS term FROM n WHERE type IN ({types})) WHERE length(term) >= 4)"


_UUID = "'vulnerability--' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(CAST('0x' || substr(h, 17, 1) AS INT) % 4 + 1 AS INT), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"
_LINK_HEAD = f"WITH v_records AS ({VIEWS['v_records']}), " + _VIEWS.removeprefix("WITH ").rstrip() + ", " + META_SQL + f""", cv AS (SELECT id, trim(unnest(string_split(cve_ids, ','))) AS name FROM r WHERE cve_ids IS NOT NULL),
vn AS (SELECT {_UUID} AS stix_id, name, first_id FROM (SELECT name, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(name)) AS h, min(id) AS first_id FROM cv GROUP BY name)), tk AS (SELECT id, domain, trim(unnest(string_split(mitre_techniques, ','))) AS tech FROM r WHERE mitre_techniques IS NOT NULL), tn AS (SELECT attack_id, max(stix_id) AS stix_id FROM n WHERE attack_id IS NOT NULL GROUP BY 1),
ln AS (SELECT stix_id, record_id, arg_min(link_type, strategy) AS link_type, arg_min(confidence, strategy) AS confidence, min(strategy) AS strategy FROM (
SELECT vn.stix_id, cv.id AS record_id, 'about' AS link_type, 1.0 AS confidence, 1 AS strategy FROM cv JOIN vn USING (name)
UNION ALL SELECT tn.stix_id, tk.id, 'about', 1.0, 2 FROM tk JOIN tn ON tech = attack_id WHERE domain NOT IN ('siem_queries', 'sigma_rules', 'log_analysis')
UNION ALL SELECT DISTINCT t.stix_id, x.id, 'about', 0.8, 3 FROM ({_keys_sql('id', "user_message || ' ' || assistant_message", "r WHERE domain = 'apt_intel'")}) x JOIN ({_terms_sql("'intrusion-set'", '[name] || aliases')}) t USING (key) WHERE regexp_matches(t, '(?i)\\b' || regexp_escape(term) || '\\b')
UNION ALL SELECT tn.stix_id, tk.id, 'detects', 1.0, 4 FROM tk JOIN tn ON tech = attack_id WHERE domain IN ('siem_queries', 'sigma_rules')
UNION ALL SELECT tn.stix_id, tk.id, 'analyzes', 1.0, 5 FROM tk JOIN tn ON tech = attack_id WHERE domain = 'log_analysis') GROUP BY stix_id, record_id) """


@add("A09_A10_J04_vulnerability_nodes", "SELECT vn.stix_id, vn.name, substring(r.assistant_message, 1, 500) AS description, r.severity, r.cvss_score FROM vn JOIN r ON r.id = first_id", _LINK_HEAD)
def _(spark, d):
    rows = records_with_ids(spark, d).withColumn("quality_score", F.lit(None).cast("double"))
    return linking.vulnerability_nodes(rows).drop("type")


@add("J05_J07_J10_J11_J12_K05_links", "SELECT stix_id, record_id, link_type, CAST(confidence AS DOUBLE) AS confidence, strategy FROM ln", _LINK_HEAD)
def _(spark, d):
    return linked(spark, d)[2]


@add("J01_records_of_objects", "SELECT ln.stix_id, r.id, r.domain, link_type FROM ln JOIN r ON r.id = ln.record_id", _LINK_HEAD)
def _(spark, d):
    rows, _, found = linked(spark, d)
    return found.join(rows.select(F.col("id").alias("record_id"), "domain"), "record_id").select("stix_id", F.col("record_id").alias("id"), "domain", "link_type")


@add("J02_objects_of_records", "SELECT record_id, stix_id, o.type, o.name, link_type, CAST(confidence AS DOUBLE) AS confidence FROM ln JOIN (SELECT stix_id, type, name FROM n UNION ALL SELECT stix_id, 'vulnerability', name FROM vn) o USING (stix_id)", _LINK_HEAD)
def _(spark, d):
    _, nodes, found = linked(spark, d)
    return found.join(nodes.select("stix_id", "type", "name"), "stix_id").select("record_id", "stix_id", "type", "name", "link_type", "confidence")


@add("J03_A03_U03_merged_stats", "SELECT name, coalesce(max(n) FILTER (WHERE k = 'o'), 0) AS object_count, coalesce(max(n) FILTER (WHERE k = 'r'), 0) AS relationship_count, coalesce(max(n) FILTER (WHERE k = 'l'), 0) AS link_count FROM (SELECT 'o' AS k, type AS name, count(*) AS n FROM (SELECT type FROM n UNION ALL SELECT 'vulnerability' FROM vn) GROUP BY 2 UNION ALL SELECT 'r', rel_type, count(*) FROM e GROUP BY 2 UNION ALL SELECT 'l', CASE WHEN stix_id LIKE 'vuln%' THEN 'vulnerability' ELSE split_part(stix_id, '--', 1) END, count(*) FROM ln GROUP BY 2) GROUP BY name", _LINK_HEAD)
def _(spark, d):
    _, nodes, found = linked(spark, d)
    return Graph(nodes, load(spark, d).edges).merged_stats(found)


_DOCS = "SELECT doc_id, ' ' || text || ' ' || CASE WHEN doc_id % 3 = 0 THEN 'by GROUP ' || CAST(doc_id % 40 AS VARCHAR(10)) ELSE 'subgroup ' || CAST(doc_id AS VARCHAR(10)) END || '. And Group ' || CAST(doc_id AS VARCHAR(10)) || '. It ran supplier#' || lpad(CAST(doc_id % 400 AS VARCHAR(10)), 9, '0') || '.' AS t FROM documents"


def _mentions_sql(types: str, names: str) -> str:
    return f"SELECT DISTINCT x.doc_id AS record_id, m.stix_id FROM ({_keys_sql('doc_id', 't', f'({_DOCS})')}) x JOIN ({_terms_sql(types, names)}) m USING (key) WHERE regexp_matches(x.t, '(?i)\\b' || regexp_escape(term) || '\\b')"


def _texts(spark, d) -> DataFrame:
    n = lambda c: c.cast("string")
    k = F.col("doc_id")
    tail = F.concat(F.when(k % 3 == 0, F.concat(F.lit("by GROUP "), n(k % 40))).otherwise(F.concat(F.lit("subgroup "), n(k))), F.lit(". And Group "), n(k), F.lit(". It ran supplier#"), F.lpad(n(k % 400), 9, "0"), F.lit("."))
    return spark.read.parquet(f"{d}/documents.parquet").select(k.alias("record_id"), F.concat(F.lit(" "), "text", F.lit(" "), tail).alias("text"))


@add("J08_J09_mentions", _mentions_sql("'intrusion-set'", "[name] || aliases"))
def _(spark, d):
    return linking.mentions(_texts(spark, d), linking.actor_names(load(spark, d).nodes))


@add("J16_mentions_of_software", _mentions_sql("'malware', 'tool'", "[name]"))
def _(spark, d):
    nodes = load(spark, d).nodes
    names = linking.actor_names(nodes, "malware").unionByName(linking.actor_names(nodes, "tool"))
    return linking.mentions(_texts(spark, d), names)


@add("J13_J19_entity_resolution", ", ix AS (SELECT key, max(stix_id) AS stix_id FROM (SELECT lower(unnest([name] || aliases)) AS key, stix_id FROM n) GROUP BY key), a AS (SELECT s_suppkey AS actor, s_name AS nm, ['none', 'GROUP ' || CAST(s_suppkey % 90 AS VARCHAR(10)), 'x3'] AS sy FROM supplier), p AS (SELECT actor, unnest([nm] || sy) AS term, unnest(range(4)) AS pos FROM a) SELECT a.actor, arg_min(ix.stix_id, pos) AS stix_id FROM a LEFT JOIN p USING (actor) LEFT JOIN ix ON key = lower(CASE WHEN pos = 0 THEN '?' ELSE '' END || term) GROUP BY a.actor")
def _(spark, d):
    names = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("actor"), F.concat(F.lit("?"), "s_name").alias("name"), F.array(F.lit("none"), F.concat(F.lit("GROUP "), (F.col("s_suppkey") % 90).cast("string")), F.lit("x3")).alias("synonyms"))
    return linking.resolve(names, load(spark, d).name_index()).select("actor", "stix_id")


@add("J14_merge_aliases", "SELECT stix_id, aliases || list_filter(['GROUP ' || split_part(stix_id, '--', 2), 'New'], lambda x: NOT list_contains(list_transform(aliases, lambda y: lower(y)), lower(x))) AS aliases FROM n WHERE type = 'intrusion-set'")
def _(spark, d):
    n = load(spark, d).of_type("intrusion-set")
    more = F.array(F.concat(F.lit("GROUP "), F.substring_index("stix_id", "--", -1)), F.lit("New"))
    return n.select("stix_id", linking.merge_aliases(F.col("aliases"), more).alias("aliases"))


@add("J25_shared_software", "SELECT a.src AS grp, b.src AS other, count(*) AS n FROM e a JOIN e b ON a.dst = b.dst AND a.src <> b.src WHERE a.rel_type = 'uses' AND b.rel_type = 'uses' AND a.src LIKE 'malware--%' AND b.src LIKE 'malware--%' GROUP BY 1, 2")
def _(spark, d):
    use = load(spark, d).neighbours("uses", "attack-pattern", source_type="malware").select("stix_id", "other_id")
    a, b = use.select(F.col("stix_id").alias("grp"), "other_id"), use.select(F.col("stix_id").alias("other"), "other_id")
    return a.join(b, "other_id").where("grp <> other").groupBy("grp", "other").agg(F.count(F.lit(1)).alias("n"))


@add("J29_three_hops", ", c AS (SELECT DISTINCT ln.stix_id AS cve, l2.stix_id AS tech FROM ln JOIN ln l2 USING (record_id) WHERE ln.stix_id LIKE 'vuln%' AND l2.stix_id LIKE 'attack%') SELECT DISTINCT cve, actor FROM c JOIN ut USING (tech)", _LINK_HEAD)
def _(spark, d):
    found = linked(spark, d)[2].persist()
    cves = found.where("stix_id LIKE 'vuln%'").select("record_id", F.col("stix_id").alias("cve"))
    techs = found.where("stix_id LIKE 'attack%'").select("record_id", F.col("stix_id").alias("tech"))
    actors = load(spark, d).technique_actors().select(F.col("stix_id").alias("tech"), F.col("other_id").alias("actor"))
    return cves.join(techs, "record_id").select("cve", "tech").distinct().join(actors, "tech").select("cve", "actor").distinct()
