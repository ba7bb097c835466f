"""Queries over feeds that are landed as files first and then read by the sources."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.plans import feed_reports, reports
from orefold.sources import conversations, feeds, settings, simulator, sqlite
from orefold.sources.landing import land_each, land_file, new_folder, put

Q, SQL = {}, {}


def add(name, sql=None):
    def keep(f):
        Q[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def _table(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _cat(*parts) -> Column:
    """Columns and literals joined; strings are literals."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


# Conversations


def _turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


_ASK, _ANSWER = "'Who is ' || c_name || '?'", "'A customer of ' || c_mktsegment || '.'"


def _customers(spark, d) -> DataFrame:
    ask, answer = _cat("Who is ", F.col("c_name"), "?"), _cat("A customer of ", F.col("c_mktsegment"), ".")
    return _table(spark, d, "customer").select("c_custkey", ask.alias("ask"), answer.alias("answer"))


@add("S01_S07_S26_jsonl_files", f"SELECT CASE WHEN c_custkey % 3 = 0 THEN 'val' ELSE 'train' END AS split, {_ASK} AS user_message, {_ANSWER} AS assistant_message FROM customer UNION ALL SELECT CASE WHEN k = 0 THEN 'val' ELSE 'train' END, 'bad lines', CAST(n AS VARCHAR) FROM (SELECT CAST(c_custkey % 3 = 0 AS INT) * -1 + 1 AS k, count(*) AS n FROM customer WHERE c_custkey % 5 = 0 GROUP BY 1)")
def _(spark, d):
    """Two files: objects with messages and bare arrays, blank and # lines, and bad JSON."""
    folder = new_folder(spark)
    turns = F.array(_turn("user", F.lit("earlier")), _turn("user", F.col("ask")), _turn("assistant", F.col("answer")))
    line = F.when(F.col("c_custkey") % 2 == 0, F.to_json(F.struct(turns.alias("messages")))).otherwise(F.to_json(turns))
    odd = F.array(F.lit(""), F.lit("# note"), F.lit("   "), F.when(F.col("c_custkey") % 5 == 0, "{bad"))
    rows = _customers(spark, d).select((F.col("c_custkey") % 3 == 0).alias("val"), F.explode(F.array_compact(F.concat(F.array(line), odd))).alias("value"))
    read = None
    for name, which in (("train.jsonl", ~F.col("val")), ("held.jsonl", F.col("val"))):
        df = conversations.read_jsonl(spark, land_file(rows.where(which).select("value"), f"{folder}/{name}"))
        read = df if read is None else read.unionByName(df)
    bad = conversations.skipped(read).select(F.when(F.col("file").contains("train"), "train").otherwise("val").alias("split"), F.lit("bad lines").alias("user_message"), _s("bad_lines").alias("assistant_message"))
    return conversations.pairs(read).select("split", "user_message", "assistant_message").unionByName(bad)


@add("S03_S04_S05_P13_markdown_directory", f"SELECT 'a.md' AS file, '<|system|>' || chr(10) || 'P</s>' || chr(10) || '<|user|>' || chr(10) || {_ASK} || '</s>' || chr(10) || '<|assistant|>' || chr(10) || {_ANSWER} || chr(10) || 'Second line.</s>' || chr(10) AS text FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'b.jsonl', '<|system|>' || chr(10) || 'own</s>' || chr(10) || '<|user|>' || chr(10) || {_ASK} || '</s>' || chr(10) FROM customer WHERE c_custkey % 2 = 1")
def _(spark, d):
    """A Markdown file with comments and a system turn to add, a JSONL file with one of its own, and a README that is left out."""
    folder, c = new_folder(spark), _customers(spark, d)
    block = _cat("<!-- c -->\n**user**: ", F.col("ask"), "\n**assistant**: ", F.col("answer"), "\nSecond line.\n---")
    land_file(c.where("c_custkey % 2 = 0").select(block), f"{folder}/a.md")
    land_file(c.limit(1).select(F.lit("**user**: no")), f"{folder}/README.md")
    land_file(c.where("c_custkey % 2 = 1").select(F.to_json(F.array(_turn("system", F.lit("own")), _turn("user", F.col("ask"))))), f"{folder}/b.jsonl")
    return conversations.read_directory(spark, folder, "P").select("file", conversations.render(F.col("messages")).alias("text"))


@add("S06_S08_S32_S33_P14_P15_datasets", f"SELECT layout, CASE layout WHEN 'text' THEN {_ASK} ELSE '<|user|>' || chr(10) || {_ASK} || '</s>' || chr(10) || '<|assistant|>' || chr(10) || {_ANSWER} || '</s>' || chr(10) END AS text FROM customer, (SELECT unnest(['messages', 'conversations', 'text', 'default', 'jsonl']) AS layout)")
def _(spark, d):
    """Folders of three layouts, one found as the default, and a JSONL file; each formats to text by its columns."""
    folder, c = new_folder(spark), _customers(spark, d)
    messages = F.array(_turn("user", F.col("ask")), _turn("assistant", F.col("answer")))
    old = F.array(*(F.struct(F.lit(a).alias("from"), F.col(b).alias("value")) for a, b in (("human", "ask"), ("gpt", "answer"))))
    c.select(messages.alias("messages"), "c_custkey").write.parquet(f"{folder}/prepared")
    c.select(old.alias("conversations")).write.parquet(f"{folder}/old")
    c.select(F.col("ask").alias("text"), "c_custkey").write.parquet(f"{folder}/plain")
    land_file(c.select(F.to_json(messages)), f"{folder}/x.jsonl")
    found = {"messages": f"{folder}/prepared", "conversations": f"{folder}/old", "text": f"{folder}/plain", "default": None, "jsonl": f"{folder}/x.jsonl"}
    out = None
    for layout, path in found.items():
        df = conversations.formatted(conversations.read_dataset(spark, path, folder)).select(F.lit(layout).alias("layout"), "text")
        out = df if out is None else out.unionByName(df)
    return out


@add("S27_P22_multimodal", f"SELECT c_custkey, 'frame' || c_custkey || '.png' AS image, {_ASK} AS prompt, {_ANSWER} AS answer, 2 AS turns FROM customer")
def _(spark, d):
    """Conversations with an image part, written and read as JSON lines."""
    c = _customers(spark, d).select("c_custkey", conversations.multimodal(F.col("ask"), _cat("frame", _s("c_custkey"), ".png"), F.col("answer")).alias("messages"))
    path = f"{new_folder(spark)}/vlm"
    c.write.json(path)
    m = F.col("messages")
    text = lambda i, j: m[i]["content"][j]["text"]
    return spark.read.schema(c.schema).json(path).select("c_custkey", conversations.image_of(m[0]["content"]).alias("image"), text(0, 1).alias("prompt"), text(1, 0).alias("answer"), F.size(m).alias("turns"))


# Threat feeds

_REF = "struct<source_name:string,external_id:string>"


def _objects(spark, d) -> DataFrame:
    """Objects of a STIX bundle made of customers, parts and order lines; some revoked, deprecated or of other types."""
    ref = lambda name, x: F.struct(F.lit(name).alias("source_name"), x.alias("external_id"))
    c, p = _table(spark, d, "customer"), _table(spark, d, "part")
    k = F.col("c_custkey")
    actors = c.select(
        F.lit("intrusion-set").alias("type"),
        _cat("intrusion-set--", _s(k)).alias("id"),
        F.col("c_name").alias("name"),
        F.array(F.lower("c_name"), _cat("Group ", _s(k)), _cat("GROUP ", _s(k))).alias("aliases"),
        F.array(ref("mitre-attack", _cat("G", _s(k))), ref("x", F.lit("1")), ref("x", _s(k))).alias("external_references"),
        (k % 7 == 0).alias("revoked"),
        F.when(k % 11 == 0, True).alias("x_mitre_deprecated"),
    )
    n = F.col("p_partkey")
    phase = lambda chain, x: F.struct(F.lit(chain).alias("kill_chain_name"), F.lit(x).alias("phase_name"))
    techniques = p.select(
        F.when(n % 13 == 0, "identity").otherwise("attack-pattern").alias("type"),
        _cat("attack-pattern--", _s(n)).alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("description"),
        F.when(n % 2 == 0, F.array(ref("mitre-attack", _cat("T", _s(1000 + n % 9000))))).alias("external_references"),
        F.array(phase("other", "none"), phase("mitre-attack", "execution"), phase("mitre-attack", "impact")).alias("kill_chain_phases"),
        F.array(F.col("p_brand")).alias("x_mitre_platforms"),
    )
    uses = _table(spark, d, "lineitem").join(_table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).where("l_linenumber = 1")
    edges = uses.select(F.lit("relationship").alias("type"), _cat("relationship--", _s("o_orderkey"), "-", _s("l_partkey")).alias("id"), _cat("intrusion-set--", _s("o_custkey")).alias("source_ref"), _cat("attack-pattern--", _s("l_partkey")).alias("target_ref"), F.lit("uses").alias("relationship_type"))
    return actors.unionByName(techniques, allowMissingColumns=True).unionByName(edges, allowMissingColumns=True)


def _bundle(spark, d) -> DataFrame:
    """The objects as several bundle files, read back."""
    o = _objects(spark, d)
    some = o.groupBy((F.xxhash64("id") % 8).alias("name")).agg(F.to_json(F.struct(F.collect_list(F.struct(*o.columns)).alias("objects"))).alias("value"))
    return feeds.read_bundle(spark, land_each(some, new_folder(spark), "bundles"))


@add("S09_S11_S12_G22_P05_P06_N02_N03_N04_N05_bundle_nodes", """SELECT 'intrusion-set--' || c_custkey AS stix_id, 'intrusion-set' AS type, c_name AS name, 'Group ' || c_custkey AS aliases, '' AS description, 'G' || c_custkey AS attack_id, 'mitre_attack_id=G' || c_custkey || ';x=' || c_custkey AS external_ids, '' AS platforms, '' AS phases FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0
UNION ALL SELECT 'attack-pattern--' || p_partkey, 'attack-pattern', p_name, '', p_type, CASE WHEN p_partkey % 2 = 0 THEN 'T' || (1000 + p_partkey % 9000) END, CASE WHEN p_partkey % 2 = 0 THEN 'mitre_attack_id=T' || (1000 + p_partkey % 9000) ELSE '' END, p_brand, 'execution,impact' FROM part WHERE p_partkey % 13 <> 0""")
def _(spark, d):
    n = feeds.nodes_of_bundle(_bundle(spark, d))
    entry = lambda e: _cat(e["key"], "=", F.array_join(e["value"], "|"))
    external = F.array_join(F.transform(F.array_sort(F.map_entries("external_ids")), entry), ";")
    return n.select("stix_id", "type", "name", F.array_join("aliases", "|").alias("aliases"), "description", "attack_id", external.alias("external_ids"), F.array_join("platforms", ",").alias("platforms"), F.array_join("kill_chain_phases", ",").alias("phases"))


_LIVE = "c_custkey % 7 <> 0 AND c_custkey % 11 <> 0"


@add("J18_K04_A04_A33_bundle_edges", f"WITH e AS (SELECT DISTINCT 'relationship--' || o_orderkey || '-' || l_partkey AS relationship_id, 'intrusion-set--' || o_custkey AS src, 'attack-pattern--' || l_partkey AS dst, 'uses' AS rel_type FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = 1 JOIN customer ON c_custkey = o_custkey AND {_LIVE} JOIN part ON p_partkey = l_partkey AND p_partkey % 13 <> 0) SELECT 'edge' AS kind, relationship_id || ' ' || src || ' ' || dst AS name, 1 AS n FROM e UNION ALL SELECT 'type', 'intrusion-set', count(*) FROM customer WHERE {_LIVE} UNION ALL SELECT 'type', 'attack-pattern', count(*) FROM part WHERE p_partkey % 13 <> 0 UNION ALL SELECT 'relation', 'uses', count(*) FROM e")
def _(spark, d):
    """Relationships whose ends are both active, wired by the types of their ends, and what the build counts."""
    from orefold.operators import graph

    active = _bundle(spark, d)
    nodes = feeds.nodes_of_bundle(active)
    edges = graph.insert_edges(None, feeds.edges_of_bundle(active).withColumn("seq", F.xxhash64("relationship_id")), nodes)
    wired = edges.select("relationship_id", "src", "dst", "rel_type").where("src LIKE 'intrusion-set--%' AND dst LIKE 'attack-pattern--%' AND rel_type = 'uses'")
    count = lambda df, kind, c: df.groupBy(F.lit(kind).alias("kind"), F.col(c).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return wired.select(F.lit("edge").alias("kind"), F.concat_ws(" ", "relationship_id", "src", "dst").alias("name"), F.lit(1).cast("long").alias("n")).unionByName(count(nodes, "type", "type")).unionByName(count(wired, "relation", "rel_type"))


@add("S10_fresh_files", "SELECT c_custkey FROM customer")
def _(spark, d):
    """Files landed now are fresh, and none is older than a week."""
    path = f"{new_folder(spark)}/files"
    _table(spark, d, "customer").select("c_custkey").write.parquet(path)
    df = spark.read.parquet(path).select("c_custkey", "_metadata")
    return feeds.fresh(df).select("c_custkey").unionByName(df.where(F.col("_metadata.file_modification_time") < F.current_timestamp() - F.expr("INTERVAL 7 DAYS")).select("c_custkey"))


_ACTORS = "SELECT s_suppkey, 'Actor ' || s_suppkey AS name, ['A' || s_suppkey, 'B' || s_suppkey] AS synonyms, 'Country ' || s_nationkey AS country, CASE WHEN s_suppkey % 2 = 0 THEN ['Sector ' || s_nationkey % 7, 'Energy'] END AS sectors, CASE WHEN s_suppkey % 3 = 0 THEN 'State' END AS sponsor FROM supplier"


def _galaxy(spark, d) -> DataFrame:
    """Actors of a galaxy file; one without a name is left out."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    meta = F.struct(F.array(_cat("A", _s(k)), _cat("B", _s(k))).alias("synonyms"), _cat("Country ", _s(n)).alias("country"), F.when(k % 3 == 0, "State").alias("cfr-suspected-state-sponsor"), F.when(k % 2 == 0, F.array(_cat("Sector ", _s(n % 7)), F.lit("Energy"))).alias("cfr-target-category"))
    v = _table(spark, d, "supplier").select(F.struct(_cat("Actor ", _s(k)).alias("value"), _s(k).alias("uuid"), _cat("Seen since ", _s(2000 + k % 20), ".").alias("description"), meta.alias("meta")).alias("v"))
    nameless = v.limit(1).select(F.struct(F.lit("").alias("value"), F.lit("0").alias("uuid"), F.lit("").alias("description"), F.col("v.meta").alias("meta")).alias("v"))
    one = v.unionByName(nameless).groupBy((F.xxhash64("v.uuid") % 4).alias("name")).agg(F.to_json(F.struct(F.collect_list("v").alias("values"))).alias("value"))
    return feeds.read_galaxy(spark, land_each(one, new_folder(spark), "galaxy"))


@add("S13_S35_galaxy", f"SELECT CAST(s_suppkey AS VARCHAR) AS actor, name, array_to_string(synonyms, ',') AS synonyms, country, sponsor, array_to_string(sectors, ',') AS sectors FROM ({_ACTORS})")
def _(spark, d):
    return _galaxy(spark, d).select("actor", "name", F.array_join("synonyms", ",").alias("synonyms"), "country", "sponsor", F.array_join("target_categories", ",").alias("sectors"))


@add("R24_galaxy_pairs", f"WITH a AS ({_ACTORS}) SELECT 'profile' AS kind, 'What is known about the threat actor ' || name || '?' AS user_message, name || chr(10) || 'Seen since ' || (2000 + s_suppkey % 20) || '.' AS assistant_message FROM a UNION ALL SELECT 'attribution', 'What country does ' || name || ' operate from?', 'Country: ' || country || CASE WHEN sponsor IS NULL THEN '' ELSE chr(10) || 'Suspected state sponsor: ' || sponsor END FROM a UNION ALL SELECT 'targeting', 'What sectors does ' || name || ' target?', 'Sectors: ' || array_to_string(sectors, ', ') FROM a WHERE sectors IS NOT NULL UNION ALL SELECT 'aliases', 'What are known aliases of ' || name || '?', array_to_string(synonyms, ', ') FROM a")
def _(spark, d):
    return feed_reports.galaxy_pairs(_galaxy(spark, d))


@add("A11_R08_O12_inverted_index", f"WITH a AS ({_ACTORS}), x AS (SELECT 'country' AS kind, country AS key, name FROM a UNION ALL SELECT 'sector', unnest(sectors), name FROM a) SELECT kind, key, count(DISTINCT name) AS n, array_to_string(list_slice(list_sort(list(DISTINCT name)), 1, 8), ', ') AS actors FROM x GROUP BY kind, key HAVING count(DISTINCT name) >= 2")
def _(spark, d):
    """Actors of each country and sector, where there are two or more; the first eight names in order."""
    from orefold.operators.graph import inverted_index

    a = _galaxy(spark, d)
    by = [inverted_index(a.select("name", F.explode(c).alias("key")), "key", "name", 2, 8).select(F.lit(kind).alias("kind"), "key", "n", F.array_join("few", ", ").alias("actors")) for kind, c in (("country", F.array("country")), ("sector", F.col("target_categories")))]
    return by[0].unionByName(by[1])


_KEV = "SELECT 'CVE-2021-' || (1000 + p_partkey) AS cve, p_name AS vul, p_type AS vendor, p_brand AS product, p_type AS short, 'Apply updates.' AS act, p_partkey % 3 = 0 AS ransom, '2021-11-' || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') AS added, '2022-05-03' AS due FROM part"


@add("S14_R20_exploited_answers", f"WITH k AS ({_KEV}) SELECT cve, 'summary' AS kind, 'What is ' || cve || '?' AS user_message, cve || ' (' || vul || ')' || chr(10) || 'Product: ' || vendor || ' ' || product || chr(10) || 'Description: ' || short || CASE WHEN ransom THEN chr(10) || 'Used in ransomware campaigns.' ELSE '' END || chr(10) || 'Added: ' || added || chr(10) || 'Due: ' || due || chr(10) || 'Required action: ' || act AS assistant_message FROM k UNION ALL SELECT cve, 'impact', 'What is the impact of ' || cve || '?', cve || ' affects ' || vendor || ' ' || product || '.' || chr(10) || short || chr(10) || 'It is exploited in the wild.' || CASE WHEN ransom THEN chr(10) || 'Used in ransomware campaigns.' ELSE '' END FROM k UNION ALL SELECT cve, 'mitigation', 'What must be done about ' || cve || '?', 'For ' || cve || ':' || chr(10) || 'Required action: ' || act || chr(10) || 'Due: ' || due FROM k")
def _(spark, d):
    k = F.col("p_partkey")
    v = _table(spark, d, "part").select((k % 4).alias("name"), F.struct(_cat("CVE-2021-", _s(1000 + k)).alias("cveID"), F.col("p_brand").alias("product"), F.col("p_type").alias("vendorProject"), F.col("p_name").alias("vulnerabilityName"), F.col("p_type").alias("shortDescription"), F.lit("Apply updates.").alias("requiredAction"), F.lit("2022-05-03").alias("dueDate"), _cat("2021-11-", F.lpad(_s(1 + k % 28), 2, "0")).alias("dateAdded"), F.when(k % 3 == 0, "Known").otherwise("Unknown").alias("knownRansomwareCampaignUse"), F.lit("").alias("notes")).alias("v"))
    files = v.groupBy("name").agg(F.to_json(F.struct(F.collect_list("v").alias("vulnerabilities"))).alias("value"))
    return reports.kev_answers(feeds.read_kev(spark, land_each(files, new_folder(spark), "kev")))


#: What the vulnerability files hold, by the part's key k: scores of three origins or none, products, fixes and solutions or none.
_CVE = """SELECT p_partkey AS k, 'CVE-2022-' || (1000 + p_partkey) AS cve, 'A flaw in ' || p_name || ' lets attackers run code of their own.' AS text,
 CASE p_partkey % 4 WHEN 0 THEN CAST(p_partkey % 10 AS DOUBLE) + 0.5 WHEN 1 THEN 9.8 WHEN 2 THEN 4.4 END AS score, CASE p_partkey % 4 WHEN 1 THEN 'CRITICAL' END AS own_severity, p_type || ' ' || p_brand AS product, CAST(p_size AS VARCHAR) || '.1' AS fix,
 CASE WHEN p_partkey % 5 = 0 THEN 'Update the package' WHEN p_partkey % 5 = 1 THEN 'Turn it off' END AS solution, 'CWE-' || (p_partkey % 90 + 1) AS cwe, p_partkey % 3 = 0 AS fixed FROM part WHERE p_partkey % 9 <> 0"""
_CVE_HEAD = f"WITH c0 AS ({_CVE}), c AS (SELECT *, coalesce(own_severity, CASE WHEN score >= 9 THEN 'CRITICAL' WHEN score >= 7 THEN 'HIGH' WHEN score >= 4 THEN 'MEDIUM' WHEN score IS NOT NULL THEN 'LOW' END) AS severity, CASE WHEN fixed THEN '- ' || product || ': ' || fix ELSE '' END AS fixes FROM c0) "


def _cves(spark, d) -> DataFrame:
    """Vulnerability files in year folders: one in nine rejected, some of a year that is not read."""
    k, p = F.col("p_partkey"), _table(spark, d, "part")
    metric = lambda score, severity: F.struct(score.alias("baseScore"), severity.alias("baseSeverity"))
    none = F.lit(None).cast("string")
    metrics = F.when(k % 4 == 0, F.array(F.struct(metric((k % 10).cast("double") + 0.5, none).alias("cvssV3_1"), metric(F.lit(1.0), none).alias("cvssV3_0")))).when(k % 4 == 2, F.array(F.struct(F.lit(None).alias("cvssV3_1"), metric(F.lit(4.4), none).alias("cvssV3_0"))))
    adp = F.when(k % 4 == 1, F.array(F.struct(F.array(F.struct(metric(F.lit(9.8), F.lit("CRITICAL")).alias("cvssV3_1"))).alias("metrics"), F.array(F.struct(F.array(F.struct(_cat("CWE-", _s(k % 90 + 1)).alias("cweId"), _cat("CWE-", _s(k % 90 + 1), " Again").alias("description"))).alias("descriptions"))).alias("problemTypes"))))
    version = lambda kind, less: F.struct(F.lit("affected").alias("status"), F.lit("1.0").alias("version"), F.lit(kind).alias("versionType"), less.alias("lessThan"))
    affected = F.array(F.struct(F.col("p_type").alias("vendor"), F.col("p_brand").alias("product"), F.array(version("semver", F.when(k % 3 == 0, _cat(_s("p_size"), ".1"))), version("git", F.lit("abc"))).alias("versions")), F.struct(F.lit("n/a").alias("vendor"), F.lit("n/a").alias("product"), F.array(version("semver", F.lit("2"))).alias("versions")))
    text = _cat("A flaw in <b>", F.col("p_name"), "</b> lets attackers run code of their own.")
    cna = F.struct(
        F.array(F.struct(F.lit("de").alias("lang"), F.lit("Eine Luecke in einem Paket erlaubt es, Code auszufuehren.").alias("value")), F.struct(F.lit("en-US").alias("lang"), F.when(k % 9 == 8, F.lit("too short")).otherwise(text).alias("value"))).alias("descriptions"),
        metrics.alias("metrics"),
        F.array(F.struct(F.array(F.struct(_cat("CWE-", _s(k % 90 + 1)).alias("cweId"), _cat("CWE-", _s(k % 90 + 1), " Overflow").alias("description"))).alias("descriptions"))).alias("problemTypes"),
        affected.alias("affected"),
        F.when(k % 5 == 0, F.array(F.struct(F.lit("").alias("value")), F.struct(F.lit("<p>Update the package</p>").alias("value")))).alias("solutions"),
        F.when(k % 5 <= 1, F.array(F.struct(F.lit("Turn it off").alias("value")))).alias("workarounds"),
        F.array(F.struct(_cat("https://x/", _s(k)).alias("url"), F.array(F.lit("patch")).alias("tags")), F.struct(F.lit("https://y").alias("url"), F.array(F.lit("other")).alias("tags"))).alias("references"),
    )
    files = p.select(F.when(k % 9 == 7, "2019").otherwise("2022").alias("year"), F.to_json(F.struct(F.struct(F.when(k % 9 == 0, "REJECTED").otherwise("PUBLISHED").alias("state"), _cat("CVE-2022-", _s(1000 + k)).alias("cveId"), F.lit("2022-03-04T05:06:07Z").alias("datePublished")).alias("cveMetadata"), F.struct(cna.alias("cna"), adp.alias("adp")).alias("containers"))).alias("value"))
    return files


@add("S15_P10_P20_P21_N06_N07_N08_N09_N10_N11_R16_R17_R18_R19_F40_vulnerability_answers", _CVE_HEAD + """SELECT cve, 'summary' AS kind, CASE CAST(('0x' || md5(cve))::UHUGEINT % 2 AS INT) WHEN 0 THEN 'Summarize ' || cve || '.' ELSE 'What is ' || cve || '?' END AS user_message, cve || CASE WHEN score IS NULL THEN '' ELSE ' (' || lower(severity) || ', CVSS ' || CAST(score AS VARCHAR) || ')' END || ' - ' || text || chr(10) || 'Weakness: ' || cwe || ' (Overflow)' || chr(10) || 'Affected: ' || product || CASE WHEN fixes = '' THEN '' ELSE chr(10) || 'Fix versions:' || chr(10) || fixes END || chr(10) || 'Published: 2022-03-04' AS assistant_message FROM c WHERE k % 9 <> 8
UNION ALL SELECT cve, 'impact', 'What is the impact of ' || cve || ' and how serious is it?', CASE WHEN score IS NULL THEN cve || ' is categorized as ' || cwe || ' (Overflow).' ELSE cve || ' has a CVSS base score of ' || CAST(score AS VARCHAR) || ' (' || severity || ').' END || chr(10) || text || chr(10) || 'Affected products: ' || product FROM c WHERE k % 9 <> 8
UNION ALL SELECT cve, 'mitigation', 'How is ' || cve || ' mitigated?', 'To remediate ' || cve || ':' || CASE WHEN fixes = '' THEN '' ELSE chr(10) || fixes END || CASE WHEN solution IS NULL THEN '' ELSE chr(10) || solution END || chr(10) || 'References:' || chr(10) || '- https://x/' || k FROM c WHERE k % 9 <> 8 AND (fixed OR solution IS NOT NULL)""")
def _(spark, d):
    files = _cves(spark, d)
    return reports.cve_answers(files.select(F.from_json("value", feeds.CVE).alias("v")).select("v.*").where("cveMetadata.state = 'PUBLISHED'"))


@add("S15_years_of_vulnerability_files", "SELECT 'CVE-' || (2019 + n_regionkey) || '-' || (1000 + n_nationkey) AS cve, n_name AS vendor FROM nation WHERE n_regionkey IN (1, 2)")
def _(spark, d):
    """A file for each nation in the folder of its region's year; two years are read, by their folders alone."""
    folder = new_folder(spark)
    for r in _table(spark, d, "nation").select("n_nationkey", "n_regionkey", "n_name").toLocalIterator():
        year, cve = 2019 + r["n_regionkey"], f"CVE-{2019 + r['n_regionkey']}-{1000 + r['n_nationkey']}"
        held = {"cveMetadata": {"state": "PUBLISHED", "cveId": cve}, "containers": {"cna": {"affected": [{"vendor": r["n_name"], "product": "p"}]}}}
        put(spark, f"{folder}/{year}/0xxx/{cve}.json", json.dumps(held, indent=1))
        put(spark, f"{folder}/{year}/0xxx/delta-{cve}.json", "{}")
    found = feeds.read_cves(spark, folder, 2020, 2021)
    return found.select(F.col("cveMetadata.cveId").alias("cve"), F.col("containers.cna.affected")[0]["vendor"].alias("vendor"))


# Rules, searches, actions and stores


def _rules(spark, d) -> DataFrame:
    """Rule files of the suppliers, read below folders; one in four without a technique."""
    k = F.col("s_suppkey")
    status = F.when(k % 3 == 0, "stable").when(k % 3 == 1, "test").otherwise("odd")
    level = F.when(k % 2 == 0, "high").otherwise("low")
    text = _cat("title: 'Rule of ", F.col("s_name"), "'\nstatus: ", status, "\nlogsource:\n  product: linux\ntags:\n", F.when(k % 4 == 0, "  - attack.impact").otherwise(_cat("  # of a kind\n  - attack.t", _s(1000 + k % 5))), "\nlevel: ", level, "\ndetection:\n  condition: all of ", _s(k), "\n")
    folder = new_folder(spark)
    for r in _table(spark, d, "supplier").select(_s(k).alias("k"), text.alias("t")).toLocalIterator():
        put(spark, f"{folder}/rules/{int(r['k']) % 3}/r{int(r['k']):09d}.yml", r["t"])
    put(spark, f"{folder}/rules/readme.txt", "tags:\n  - attack.t1000\n")
    return feeds.read_rules(spark, f"{folder}/rules")


_RULES = "SELECT s_suppkey AS k, 'Rule of ' || s_name AS title, 'T' || (1000 + s_suppkey % 5) AS technique, CASE s_suppkey % 3 WHEN 0 THEN 'stable' WHEN 1 THEN 'test' ELSE 'odd' END AS status, CASE WHEN s_suppkey % 2 = 0 THEN 'high' ELSE 'low' END AS level, CASE s_suppkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 5 END * 10 + CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 3 END AS score, 'title: ' || chr(39) || 'Rule of ' || s_name || chr(39) || chr(10) || 'status: ' || CASE s_suppkey % 3 WHEN 0 THEN 'stable' WHEN 1 THEN 'test' ELSE 'odd' END || chr(10) || 'logsource:' || chr(10) || '  product: linux' || chr(10) || 'tags:' || chr(10) || '  # of a kind' || chr(10) || '  - attack.t' || (1000 + s_suppkey % 5) || chr(10) || 'level: ' || CASE WHEN s_suppkey % 2 = 0 THEN 'high' ELSE 'low' END || chr(10) || 'detection:' || chr(10) || '  condition: all of ' || s_suppkey AS text FROM supplier WHERE s_suppkey % 4 <> 0"


@add("S16_S17_A08_F27_best_rules", f"WITH r AS ({_RULES}) SELECT technique AS technique_id, arg_min(title, [score * 1000000000000 + (k % 3) * 1000000000 + k]) AS title, CAST(min(score) AS INT) AS score FROM r GROUP BY technique")
def _(spark, d):
    from orefold.functions import text as tx

    return feeds.best_rules(_rules(spark, d)).select("technique_id", tx.yaml_field(F.col("text"), "title").alias("title"), F.col("score").cast("int").alias("score"))


@add("R25_R34_R35_F28_rule_pairs", f"WITH r AS ({_RULES}) SELECT 'sigma_write' AS kind, 'Write a Sigma rule for ' || title || '.' AS user_message, '```yaml' || chr(10) || text || chr(10) || '```' AS assistant_message FROM r UNION ALL SELECT 'sigma_explain', 'What does the Sigma rule ' || title || ' do?', 'This rule detects: ' || title || '.' || chr(10) || 'Techniques: ' || technique || chr(10) || 'Log source: linux' || chr(10) || 'Condition: all of ' || k || chr(10) || 'Level: ' || level FROM r")
def _(spark, d):
    return feed_reports.rule_pairs(_rules(spark, d))


@add("J15_W10_A33_rules_and_techniques", f"WITH r AS ({_RULES}), t AS (SELECT DISTINCT 'T' || (1000 + p_partkey) AS attack_id FROM part WHERE p_partkey % 2 = 1) SELECT technique, 'rule' || k AS rule, t.attack_id IS NOT NULL AS known FROM r LEFT JOIN t ON attack_id = technique")
def _(spark, d):
    """Rules joined with the techniques that the graph knows; the others are reported."""
    rules = _rules(spark, d).select(F.explode("technique_ids").alias("technique"), F.concat(F.lit("rule"), _s(F.regexp_extract("file", r"r0*(\d+)\.yml$", 1))).alias("rule"))
    known = _table(spark, d, "part").where("p_partkey % 2 = 1").select(_cat("T", _s(1000 + F.col("p_partkey"))).alias("technique")).distinct()
    detects = rules.join(known, "technique", "left_semi").withColumn("known", F.lit(True))
    return detects.unionByName(rules.join(known, "technique", "left_anti").withColumn("known", F.lit(False)))


_SEARCH = "'index=main sourcetype=audit user=' || n_name || ' | stats count by host, user'"


def _analyses(spark, d) -> DataFrame:
    """Analysis rows in a relational file of their own: lists, objects with searches, bad JSON and short queries."""
    folder = new_folder(spark)
    rows = []
    for r in _table(spark, d, "nation").select("n_nationkey", "n_name").toLocalIterator():
        long = {"title": f"Look at {r['n_name']}", "query": f"index=main sourcetype=audit user={r['n_name']} | stats count by host, user", "description": "d"}
        listed = json.dumps([long, {"title": "short", "query": "index=main", "description": ""}])
        nested = "{bad" if r["n_nationkey"] % 3 == 0 else json.dumps({"searches": [long]})
        rows.append((f"{r['n_name']}.log", listed, nested))
    return sqlite.read(spark, sqlite.land(spark, f"{folder}/store.db", "analysis_results", ("filename", "suggested_searches", "tstats_searches"), rows), "analysis_results", "filename string, suggested_searches string, tstats_searches string")


@add("S18_S19_S20_P11_relational_store", f"SELECT n_name || '.log' AS filename, kind, 'Look at ' || n_name AS title, {_SEARCH} AS query, 'd' AS description FROM nation, (SELECT unnest(['search', 'tstats']) AS kind) WHERE kind = 'search' OR n_nationkey % 3 <> 0")
def _(spark, d):
    return feeds.queries_of_analysis(_analyses(spark, d))


@add("S21_S22_P08_simulator_client", "SELECT 'T' || (1000 + n_nationkey) AS technique_id, i AS number, '{\"action\":\"' || n_name || '\"}' AS event FROM nation, (SELECT unnest([0, 1]) AS i) WHERE n_nationkey % 6 <> 5")
def _(spark, d):
    """Events of a simulator for each technique: busy at first for some, unknown for others; label fields are not shown."""
    n = {f"T{1000 + r['n_nationkey']}": (r["n_nationkey"], r["n_name"]) for r in _table(spark, d, "nation").collect()}
    keys = spark.createDataFrame([(k,) for k in n], "technique_id string")

    def fetch(technique: str, attempt: int) -> list[dict]:
        k, name = n[technique]
        if k % 6 == 5:
            raise simulator.Unknown(technique)
        if attempt < k % 3:
            raise simulator.Busy(technique)
        return [{"action": name, "label": "bad", "note": ""}] * 2

    found = simulator.fetch_events(keys, "technique_id", fetch, waits=(0.0, 0.0))
    return found.select("technique_id", "number", feeds.shown_fields(F.col("event"), ("action", "note")).alias("event"))


@add("S23_S31_actions_csv", "SELECT CAST(o_custkey AS INT) AS episode, CAST(o_orderkey % 1000 AS INT) AS frame_index, arg_max(o_orderpriority, o_orderkey) AS action FROM orders GROUP BY 1, 2")
def _(spark, d):
    """Action logs in which frames repeat: the last row of a frame holds."""
    path = f"{new_folder(spark)}/actions"
    k = F.col("o_orderkey")
    log = _table(spark, d, "orders").select(F.col("o_custkey").alias("episode"), (k % 1000).alias("frame_index"), _cat("f", _s(k % 1000)).alias("frame_path"), F.col("o_orderpriority").alias("action"), k.cast("double").alias("timestamp"))
    log.write.option("header", True).csv(path)
    return feeds.read_actions(spark, path).select("episode", "frame_index", "action")


@add("J21_frames_on_disk", "SELECT o_orderkey AS frame, 'f' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN '.png' WHEN o_orderkey % 3 = 1 THEN '.ppm' END AS found FROM orders")
def _(spark, d):
    """Frames named by a log and the files that are there: the PNG, else the PPM, else none."""
    k = F.col("o_orderkey")
    o = _table(spark, d, "orders")
    log = o.select(k.alias("frame"), _cat("f", _s(k)).alias("frame_path"))
    there = o.where(k % 3 == 0).select(_cat("f", _s(k), ".png").alias("file")).unionByName(o.where(k % 3 <= 1).select(_cat("f", _s(k), ".ppm").alias("file")))
    return feeds.with_frame_files(log, there).select("frame", F.col("file").alias("found"))


@add("S24_S25_P16_episode_frames", "SELECT o_custkey AS episode_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS frame_index, 'f' || o_orderkey AS frame_path, CAST(o_orderkey % 5 AS INT) AS action_id, o_totalprice AS reward FROM orders")
def _(spark, d):
    """Episodes as parallel arrays, as frames again."""
    path = f"{new_folder(spark)}/episodes"
    k = F.col("o_orderkey")
    step = F.struct(k.alias("k"), _cat("f", _s(k)).alias("f"), (k % 5).cast("int").alias("a"), F.col("o_totalprice").alias("r"))
    s = F.array_sort(F.collect_list(step))
    _table(spark, d, "orders").groupBy("o_custkey").agg(s.alias("s")).select("o_custkey", F.col("s.f").alias("images"), F.col("s.a").alias("actions"), F.col("s.r").alias("rewards")).write.parquet(path)
    return feeds.frames_of_episodes(spark.read.parquet(path), "images", "actions", "rewards", "o_custkey")


@add("S30_settings", "SELECT 'region.' || r_name || '.key' AS name, CAST(r_regionkey AS VARCHAR) AS value FROM region UNION ALL SELECT 'region.' || r_name || '.words', r_name || ',x' FROM region UNION ALL SELECT 'top', 'a: b'")
def _(spark, d):
    """A settings file of nested sections, lists, comments and quotes."""
    text = "# head\ntop: 'a: b'  # note\nregion:\n" + "".join(f"  {r['r_name']}:\n    key: {r['r_regionkey']}\n    words:\n      - {r['r_name']}\n      - x\n" for r in _table(spark, d, "region").collect())
    folder = new_folder(spark)
    put(spark, f"{folder}/config.yaml", text)
    return settings.read_settings(spark, f"{folder}/config.yaml")


@add("S28_S29_graph_of_files", "SELECT type, count(*) AS nodes FROM (SELECT 'customer' AS type FROM customer UNION ALL SELECT 'nation' FROM nation) GROUP BY type UNION ALL SELECT 'edges', count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(spark, d):
    """Nodes and edges stored as Parquet and loaded again."""
    from orefold.operators.graph import Graph

    folder = new_folder(spark)
    c = _table(spark, d, "customer").select(_cat("customer--", _s("c_custkey")).alias("stix_id"), F.lit("customer").alias("type"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("to"))
    n = _table(spark, d, "nation").select(_cat("nation--", _s("n_nationkey")).alias("stix_id"), F.lit("nation").alias("type"), F.col("n_name").alias("name"))
    c.drop("to").unionByName(n).write.parquet(f"{folder}/nodes")
    c.select(F.col("stix_id").alias("src"), _cat("nation--", _s("to")).alias("dst"), F.lit("in").alias("rel_type")).write.parquet(f"{folder}/edges")
    g = Graph.load(spark, folder)
    near = g.neighbours("in", "nation")
    return g.nodes.groupBy("type").agg(F.count(F.lit(1)).alias("nodes")).unionByName(near.agg(F.count(F.lit(1)).alias("nodes")).select(F.lit("edges").alias("type"), "nodes"))
