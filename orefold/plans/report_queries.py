"""Queries over the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from orefold.functions import classify, search
from orefold.operators.graph import KILL_CHAIN, Graph
from orefold.plans import feed_reports, graph_queries, reports, search_queries
from orefold.plans.graph_queries import _CHAIN, _VIEWS, all_nodes, load
from orefold.plans.text_queries import HASH_SQL, META, _checks_sql, meta

Q, SQL = {}, {}


def add(name, sql=None):
    def keep(f):
        Q[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


for _n, _f in reports.REPORTS.items():
    Q[f"R{_n:02d}_{_f.__name__}"] = lambda spark, d, f=_f: f(load(spark, d))

Q["R04_vulnerability_chains"] = lambda spark, d: reports.vulnerability_chains(Graph(all_nodes(spark, d), load(spark, d).edges))

SQL["R02_actor_arsenal"] = _VIEWS.replace("FROM v_edges)", "FROM v_edges), z AS (SELECT src AS stix_id, o.name AS nm FROM v_edges e JOIN n o ON o.stix_id = dst AND o.type IN ('malware', 'tool') WHERE rel_type = 'uses' AND src LIKE 'intrusion-set--%')", 1) + "SELECT CASE WHEN ('0x' || md5(n.name))::UHUGEINT % 2 = 0 THEN 'What malware and tools does ' || n.name || ' use?' ELSE 'Describe the software arsenal of ' || n.name || '.' END AS user_message, n.name || ' uses ' || CAST(count(*) AS VARCHAR) || ' programs.' || chr(10) || 'Software: ' || array_to_string(list_slice(list_sort(list(DISTINCT nm)), 1, 15), ', ') AS assistant_message FROM z JOIN n USING (stix_id) GROUP BY z.stix_id, n.name"


@add("R09_rule_coverage", _VIEWS + "SELECT 'How well do rules cover ' || name || '?' AS user_message, c || ' of ' || t || ' techniques, ' || p || '% (' || CASE WHEN p < 50 THEN 'LOW' WHEN p < 80 THEN 'MODERATE' ELSE 'HIGH' END || ').' AS assistant_message FROM (SELECT actor, count(*) AS t, count(*) FILTER (WHERE tech LIKE '%7') AS c, CAST(floor(100 * count(*) FILTER (WHERE tech LIKE '%7') / count(*)) AS BIGINT) AS p FROM ut GROUP BY actor) JOIN n ON stix_id = actor")
def _(spark, d):
    g = load(spark, d)
    return reports.rule_coverage(g, g.of_type("attack-pattern").where("stix_id LIKE '%7'"))


@add("R08_targeting")
def _(spark, d):
    g = load(spark, d)
    k = F.substring_index("stix_id", "--", -1).cast("int")
    sectors = F.array(F.concat(F.lit("sector "), (k % 7).cast("string")))
    return reports.targeting(g.of_type("intrusion-set").select("name", sectors.alias("target_categories"), F.array(F.concat(F.lit("country "), (k % 30).cast("string"))).alias("victims"), F.lit("espionage").alias("motive"), F.lit("").alias("sponsor")))


@add("R10_logs_to_actors")
def _(spark, d):
    n = lambda c: F.concat(F.lit("T"), (1000 + c % 700).cast("string"))
    logs = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("id"), F.lit("log_analysis").alias("domain"), F.concat_ws(",", n(F.col("o_custkey")), n(F.col("o_custkey") + 1)).alias("mitre_techniques"))
    return reports.logs_to_actors(load(spark, d), logs)


@add("R15_U02_X08_generate")
def _(spark, d):
    return reports.generate(load(spark, d), None, (2, 7, 13), {2: 100, 7: 100}).select("category", "user_message", "domain", "question_type", "content_hash")


@add("R42_review_prompt", META + "SELECT id, '--- Record ' || CAST(id AS VARCHAR) || ' (domain: ' || domain || ') ---' || chr(10) || 'USER: ' || substring(user_message, 1, 2000) || chr(10) || 'ASSISTANT: ' || substring(assistant_message, 1, 3000) || chr(10) || 'Rate this response. Respond with ONLY the JSON object.' AS prompt FROM r")
def _(spark, d):
    return reports.review_prompt(meta(spark, d))


@add("F48_F49_F50_F51_query_builders")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    event = F.map_filter(F.create_map(F.lit("action"), F.col("event_type"), F.lit("process_name"), F.when(F.col("event_id") % 2 == 0, "cmd.exe")), lambda k, v: v.isNotNull())
    t = F.concat(F.lit("T"), (1000 + F.col("user_id") % 700).cast("string"))
    return e.select("event_id", reports.search_query(event, F.lit("wineventlog")).alias("spl"), reports.kusto_query(event).alias("kql"), reports.correlation_query(t, F.array(F.lit("a"), F.lit("b"))).alias("correlation"), reports.rule_yaml(t, F.col("event_type"), event).alias("rule"))


def log_events(spark, d):
    """Security events made of the driver's events: the technique follows the user, the source the kind of event."""
    e = spark.read.parquet(f"{d}/events.parquet")
    k = F.col("user_id") % 40
    n = lambda c: c.cast("string")
    event = F.create_map(F.lit("action"), F.col("event_type"), F.lit("event_id"), n(F.col("event_id") % 50), F.lit("label"), F.lit("bad"))
    return e.select(F.concat(F.lit("T"), n(1000 + k)).alias("technique_id"), F.concat(F.lit("Technique "), n(k)).alias("technique"), F.when(k % 2 == 0, "execution").otherwise("impact").alias("tactic"), F.when(k % 3 == 0, "high").otherwise("low").alias("severity"), F.col("event_type").alias("source"), F.concat(F.lit("st:"), "event_type").alias("sourcetype"), event.alias("event"))


_LOGS = "WITH l AS (SELECT DISTINCT 'T' || CAST(1000 + user_id % 40 AS VARCHAR) AS t, event_type AS s FROM events), m AS (SELECT t, count(*) AS n FROM l GROUP BY t HAVING count(*) >= 2) "


@add("R26_R27_R28_R29_R30_R31_R32_R33_R36_log_pairs")
def _(spark, d):
    return feed_reports.log_pairs(log_events(spark, d))


@add("R41_P07_simulator_rows", "SELECT 'T' || CAST(1000 + user_id % 40 AS VARCHAR) AS technique_id, event_type AS source, '{\"action\":\"' || event_type || '\",\"event_id\":\"' || CAST(event_id % 50 AS VARCHAR) || '\"}' AS event FROM events")
def _(spark, d):
    return feed_reports.simulator_rows(log_events(spark, d))


@add("R37_response_actions", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '- Escalate to incident response' || chr(10) ELSE '' END || CASE WHEN event_id % 3 = 0 THEN '- Segment the affected hosts' || chr(10) ELSE '' END || '- Preserve the logs' || chr(10) || '- Document the findings' AS steps FROM events")
def _(spark, d):
    tactic, severity = F.when(F.col("event_id") % 3 == 0, "lateral-movement").otherwise("none"), F.when(F.col("event_id") % 2 == 0, "HIGH").otherwise("low")
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", feed_reports.response_actions(tactic, severity).alias("steps"))


@add("R21_R22_technique_pairs", _VIEWS + f", t AS (SELECT attack_id || ' ' || name AS x, CAST(split_part(stix_id, '--', 2) AS INT) AS k, list_position({_CHAIN}, phases[1]) AS i FROM n WHERE attack_id IS NOT NULL) SELECT 'description' AS kind, 'Describe the technique ' || x || '.' AS user_message, x || ': Seen with CVE-' || (2000 + k % 26) || '-' || (1000 + k % 90) || '.' AS assistant_message FROM t UNION ALL SELECT 'tactic', 'Which tactic does ' || x || ' belong to?', x || ' belongs to: ' || (TITLES)[i] FROM t")
def _(spark, d):
    return feed_reports.technique_pairs(load(spark, d).nodes)


@add("R23_group_pairs")
def _(spark, d):
    return feed_reports.group_pairs(load(spark, d))


@add("R38_R39_R40_search_pairs")
def _(spark, d):
    return feed_reports.search_pairs(search_queries.queries(spark, d).withColumn("cron_schedule", F.lit("*/5 * * * *")))


# SQL of the graph reports; t holds phases and their titles, few(x, k) is the first k distinct names.
_TITLES = "[" + ", ".join(f"'{' '.join(w.capitalize() for w in p.split('-'))}'" for p in KILL_CHAIN) + "]"
_G = _VIEWS.rstrip() + f", t AS (SELECT unnest({_CHAIN}) AS phase, unnest({_TITLES}) AS title, unnest(range({len(KILL_CHAIN)})) AS o), p AS (SELECT stix_id AS tech, name, phases[1] AS phase FROM n WHERE type = 'attack-pattern') "


def _few(column, most):
    return f"array_to_string(list_slice(list_sort(list(DISTINCT {column})), 1, {most}), ', ')"


def _choice(key, texts):
    return f"CASE CAST(('0x' || md5({key}))::UHUGEINT % {len(texts)} AS INT) " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(texts)) + " END"


_NL = " || chr(10) || "
SQL["R01_actor_techniques"] = _G + f""", u AS (SELECT src AS actor, p.* FROM e JOIN p ON tech = dst JOIN n a ON a.stix_id = src AND a.type = 'intrusion-set' WHERE rel_type = 'uses'), c AS (SELECT actor, count(*) AS n FROM u GROUP BY 1), b AS (SELECT actor, phase, count(*) AS m, {_few('name', 6)} AS few, {_few('name', 1000)} AS al FROM u GROUP BY 1, 2)
SELECT {_choice('n.name', ["'What techniques does ' || n.name || ' use?'", "'Describe the techniques of ' || n.name || '.'"])} AS user_message, substring(n.name || ' uses ' || c.n || ' techniques.'{_NL}'Also known as: ' || array_to_string(n.aliases, ', '){_NL}x, 1, 2000) AS assistant_message FROM (SELECT actor, string_agg(title || ': ' || few, chr(10) ORDER BY b.phase) AS x FROM b JOIN t USING (phase) GROUP BY 1) JOIN c USING (actor) JOIN n ON n.stix_id = actor WHERE c.n >= 2
UNION ALL SELECT 'Which ' || lower(title) || ' techniques does ' || name || ' use?', substring(name || ' uses:'{_NL}al, 1, 2000) FROM b JOIN t USING (phase) JOIN n ON stix_id = actor WHERE m >= 2"""
SQL["R03_attribution"] = _G + f"SELECT 'Which threat actors use ' || p.name || '?' AS user_message, count(*) || ' known actors.'{_NL}{_few('a.name', 10)} AS assistant_message FROM e JOIN p ON tech = dst JOIN n a ON a.stix_id = src AND a.type = 'intrusion-set' WHERE rel_type = 'uses' GROUP BY tech, p.name UNION ALL SELECT 'Which threat actors are behind ' || c.name || '?', count(*) || ' known actors.'{_NL}{_few('a.name', 10)} FROM e JOIN n c ON c.stix_id = src AND c.type = 'campaign' JOIN n a ON a.stix_id = dst AND a.type = 'intrusion-set' WHERE rel_type = 'attributed-to' GROUP BY c.stix_id, c.name UNION ALL SELECT 'Which threat actors use ' || s.name || '?', count(*) || ' known actors.'{_NL}{_few('a.name', 10)} FROM e JOIN n s ON s.stix_id = dst AND s.type IN ('malware', 'tool') JOIN n a ON a.stix_id = src AND a.type = 'intrusion-set' WHERE rel_type = 'uses' GROUP BY dst, s.name"
SQL["R05_kill_chains"] = _G + f", u AS (SELECT src AS actor, p.* FROM e JOIN p ON tech = dst JOIN n a ON a.stix_id = src AND a.type = 'intrusion-set' WHERE rel_type = 'uses'), b AS (SELECT actor, phase, o, title, {_few('u.name', 4)} AS few FROM u JOIN t USING (phase) GROUP BY 1, 2, 3, 4), k AS (SELECT *, row_number() OVER (PARTITION BY actor ORDER BY o) AS i FROM b) SELECT {_choice('n.name', ["'Walk through an attack by ' || n.name || '.'", "'Describe the kill chain of ' || n.name || '.'"])} AS user_message, substring('A typical operation of ' || n.name || ':'{_NL}x, 1, 2000) AS assistant_message FROM (SELECT actor, count(*) AS c, string_agg(i || '. ' || title || ': ' || few, chr(10) ORDER BY i) AS x FROM k GROUP BY 1) JOIN n ON n.stix_id = actor WHERE c >= 2"
SQL["R07_mitigations"] = _G + f", m AS (SELECT DISTINCT dst AS tech, src AS mitigation FROM e WHERE rel_type = 'mitigates'), c AS (SELECT actor, mitigation, count(DISTINCT tech) AS covered FROM ut JOIN m USING (tech) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY actor ORDER BY covered DESC, mitigation) AS k FROM c) SELECT 'How can ' || p.name || ' be mitigated?' AS user_message, {_few('a.name', 10)} AS assistant_message FROM m JOIN p USING (tech) JOIN n a ON a.stix_id = mitigation GROUP BY tech, p.name UNION ALL SELECT 'How do we defend against ' || n.name || '?', substring(x, 1, 2000) FROM (SELECT actor, string_agg(name || ' (' || covered || ' techniques)', chr(10) ORDER BY k) AS x FROM r JOIN n ON stix_id = mitigation WHERE k <= 10 GROUP BY 1) JOIN n ON n.stix_id = actor"
_PART = "coalesce(chr(10) || '{title}: ' || {x}, '')"
SQL["R12_technique_overviews"] = _G + ", " + ", ".join(f"{a} AS (SELECT {near} AS tech, {_few('o.name', 8)} AS x FROM e JOIN n o ON o.stix_id = {far} AND o.type IN ({types}) WHERE rel_type = '{rel}' GROUP BY 1)" for a, near, far, types, rel in (("sb", "dst", "src", "'attack-pattern'", "subtechnique-of"), ("ac", "dst", "src", "'intrusion-set'", "uses"), ("sw", "dst", "src", "'malware', 'tool'", "uses"), ("mi", "dst", "src", "'course-of-action'", "mitigates"))) + f" SELECT {_choice('p.tech', [chr(39) + 'Give an overview of ' + chr(39) + ' || p.name || ' + chr(39) + '.' + chr(39), chr(39) + 'What is ' + chr(39) + ' || p.name || ' + chr(39) + '?' + chr(39), chr(39) + 'Explain ' + chr(39) + ' || p.name || ' + chr(39) + '.' + chr(39)])} AS user_message, substring(p.name || chr(10) || 'Tactic: ' || title || " + " || ".join(_PART.format(title=t, x=f"{a}.x") for t, a in (("Subtechniques", "sb"), ("Actors", "ac"), ("Software", "sw"), ("Mitigations", "mi"))) + ", 1, 2000) AS assistant_message FROM p JOIN t USING (phase) LEFT JOIN sb USING (tech) LEFT JOIN ac USING (tech) LEFT JOIN sw USING (tech) LEFT JOIN mi USING (tech)"
SQL["N14_errors_json"] = _checks_sql() + "SELECT id, validation_status = 'pass' AS clean, len(list_filter(string_split(checks, ','), lambda x: x <> '')) AS n FROM a"

SQL["R21_R22_technique_pairs"] = SQL["R21_R22_technique_pairs"].replace("(TITLES)", f"({_TITLES})")
_NEAR_NAMES = "SELECT {own} AS stix_id, count(*) AS n, {few} AS x FROM e JOIN n o ON o.stix_id = {other} AND o.type IN ({types}) JOIN n s ON s.stix_id = {own} AND s.type IN ({kind}) WHERE rel_type = '{rel}' GROUP BY 1"


def _near_sql(name, own, types, kind, rel, most):
    other = "dst" if own == "src" else "src"
    return f"{name} AS ({_NEAR_NAMES.format(own=own, other=other, types=types, kind=kind, rel=rel, few=_few('o.name', most))})"


def _line(title, value):
    return f"coalesce(chr(10) || '{title}: ' || {value}, '')"


SQL["R13_software_overviews"] = _VIEWS + ", " + _near_sql("te", "src", "'attack-pattern'", "'malware', 'tool'", "uses", 8) + ", " + _near_sql("ac", "dst", "'intrusion-set'", "'malware', 'tool'", "uses", 8) + f" SELECT 'What is ' || n.name || '?' AS user_message, n.name || ' is a ' || n.type || '.' || {_line('Techniques', 'te.x')} || {_line('Used by', 'ac.x')} AS assistant_message FROM n LEFT JOIN te USING (stix_id) LEFT JOIN ac USING (stix_id) WHERE n.type IN ('malware', 'tool')"
SQL["R11_data_sources"] = _VIEWS + ", " + _near_sql("w", "src", "'attack-pattern'", "'x-mitre-data-component'", "detects", 15) + " SELECT 'What does ' || name || ' detect?' AS user_message, w.n || ' techniques.' || chr(10) || x AS assistant_message FROM w JOIN n USING (stix_id)"
SQL["R06_detection_attribution"] = _VIEWS + f""", a AS (SELECT tech, actor, o.name AS who, t.name AS technique, CAST(split_part(tech, '--', 2) AS BIGINT) AS k FROM ut JOIN n o ON o.stix_id = actor JOIN n t ON t.stix_id = tech)
SELECT 'We detected ' || technique || '. Who could it be?' AS user_message, count(*) || ' actors use it.'{_NL}{_few('who', 10)} AS assistant_message FROM a GROUP BY tech, technique
UNION ALL SELECT 'We detected ' || x.technique || ' and ' || y.technique || '. Who could it be?', count(*) || ' actors use both.'{_NL}{_few('x.who', 10)} FROM a x JOIN a y ON y.actor = x.actor AND y.k = x.k + 1 GROUP BY x.tech, y.tech, x.technique, y.technique"""
SQL["R04_vulnerability_chains"] = graph_queries._LINK_HEAD + ", " + _near_sql("ac", "dst", "'intrusion-set'", "'attack-pattern'", "uses", 8) + ", " + _near_sql("mi", "dst", "'course-of-action'", "'attack-pattern'", "mitigates", 8) + f", q AS (SELECT stix_id, name, 'CVE-' || (2000 + k % 26) || '-' || (1000 + k % 90) AS cve FROM (SELECT stix_id, name, CAST(split_part(stix_id, '--', 2) AS INT) AS k FROM n WHERE type = 'attack-pattern')) SELECT 'How does ' || cve || ' fit into an attack?' AS user_message, cve || ' is used in ' || q.name || '.' || {_line('Actors', 'ac.x')} || {_line('Mitigations', 'mi.x')} AS assistant_message FROM q LEFT JOIN ac USING (stix_id) LEFT JOIN mi USING (stix_id) WHERE cve IN (SELECT name FROM vn)"
_ALSO = "array_to_string(n.aliases, ', ')"
_TOP = f"top AS (SELECT actor AS stix_id, string_agg(title || ' (' || m || ')', ', ' ORDER BY rk) AS x FROM (SELECT actor, title, count(*) AS m, row_number() OVER (PARTITION BY actor ORDER BY count(*) DESC, phase) AS rk FROM ut JOIN p USING (tech) JOIN t USING (phase) GROUP BY actor, title, phase) WHERE rk <= 5 GROUP BY 1)"


def _actor_parts(most):
    return ", ".join((_near_sql("te", "src", "'attack-pattern'", "'intrusion-set'", "uses", most), _near_sql("so", "src", "'malware', 'tool'", "'intrusion-set'", "uses", most), _near_sql("ca", "dst", "'campaign'", "'intrusion-set'", "attributed-to", most)))


SQL["R14_actor_overviews"] = _G + ", " + _actor_parts(8) + f", {_TOP} SELECT " + _choice("n.name", ["'Who is ' || n.name || '?'", "'Brief me on ' || n.name || '.'"]) + f" AS user_message, substring(n.name || chr(10) || 'Also known as: ' || {_ALSO} || {_line('Main tactics', 'top.x')} || {_line('Techniques', 'te.x')} || {_line('Software', 'so.x')} || {_line('Campaigns', 'ca.x')}, 1, 2000) AS assistant_message FROM n LEFT JOIN te USING (stix_id) LEFT JOIN so USING (stix_id) LEFT JOIN ca USING (stix_id) LEFT JOIN top USING (stix_id) WHERE n.type = 'intrusion-set'"
_DEFENCE = f"m AS (SELECT DISTINCT dst AS tech, src AS mitigation FROM e WHERE rel_type = 'mitigates'), df AS (SELECT actor AS stix_id, {_few('o.name', 5)} AS x FROM (SELECT actor, mitigation, row_number() OVER (PARTITION BY actor ORDER BY count(DISTINCT tech) DESC, mitigation) AS rk FROM ut JOIN m USING (tech) GROUP BY 1, 2) JOIN n o ON o.stix_id = mitigation WHERE rk <= 5 GROUP BY 1)"
SQL["R23_group_pairs"] = _VIEWS.rstrip() + ", " + _actor_parts(15) + f", {_DEFENCE}, a AS (SELECT n.name, {_ALSO} AS also, te.x AS techniques, so.x AS software, ca.x AS campaigns, df.x AS defence FROM n LEFT JOIN te USING (stix_id) LEFT JOIN so USING (stix_id) LEFT JOIN ca USING (stix_id) LEFT JOIN df USING (stix_id) WHERE n.type = 'intrusion-set') " + " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, '{ask}' || name || '{tail}' AS user_message, substring({answer}, 1, 2000) AS assistant_message FROM a WHERE {answer} IS NOT NULL"
    for kind, ask, tail, answer in (("profile", "Who is ", "?", "name || chr(10) || 'Also known as: ' || also"), ("techniques", "What techniques does ", " use?", "techniques"), ("software", "What malware and tools does ", " use?", "software"), ("aliases", "What is ", " also known as?", "also"), ("campaigns", "Which campaigns are attributed to ", "?", "campaigns"), ("defence", "How can we detect activity of ", "?", "'Start with: ' || defence"))
)
SQL["R08_targeting"] = f"WITH a AS (SELECT c_name AS name, 'sector ' || c_custkey % 7 AS sector, 'country ' || c_custkey % 30 AS victim FROM customer) SELECT {_choice('name', [chr(39) + 'What sectors does ' + chr(39) + ' || name || ' + chr(39) + ' target?' + chr(39), chr(39) + 'Give the targeting profile of ' + chr(39) + ' || name || ' + chr(39) + '.' + chr(39)])} AS user_message, 'Target sectors: ' || sector || chr(10) || 'Known victims: ' || victim || chr(10) || 'Motivation: espionage' AS assistant_message FROM a UNION ALL SELECT 'Which actors target the sector ' || sector || '?', count(DISTINCT name) || ' known actors.'{_NL}{_few('name', 15)} FROM a GROUP BY sector HAVING count(DISTINCT name) >= 2 UNION ALL SELECT 'Which actors target ' || victim || '?', count(DISTINCT name) || ' known actors.'{_NL}{_few('name', 15)} FROM a GROUP BY victim HAVING count(DISTINCT name) >= 2"
SQL["R10_logs_to_actors"] = _VIEWS.rstrip() + f""", k AS (SELECT attack_id AS tid, stix_id AS tech, name FROM n WHERE attack_id IS NOT NULL), l AS (SELECT o_orderkey AS id, 'T' || (1000 + o_custkey % 700) AS t1, 'T' || (1000 + (o_custkey + 1) % 700) AS t2 FROM orders), s AS (SELECT id, tid, tech, name FROM (SELECT id, unnest([t1, t2]) AS tid FROM l) JOIN k USING (tid)),
g AS (SELECT id, count(*) AS n, string_agg(tid, ', ' ORDER BY tid) AS tids FROM s GROUP BY 1 HAVING count(*) >= 2), z AS (SELECT s.id, actor FROM s JOIN ut USING (tech) JOIN g USING (id) GROUP BY s.id, actor, g.n HAVING count(*) = g.n)
SELECT 'Logs show ' || tid || '. Who could it be?' AS user_message, s.name || ' suggests:'{_NL}{_few('o.name', 10)} AS assistant_message FROM (SELECT DISTINCT tid, tech, name FROM s) s JOIN ut USING (tech) JOIN n o ON o.stix_id = actor GROUP BY tid, s.name
UNION ALL SELECT 'Logs show ' || tids || ' together. Who could it be?', {_few('o.name', 10)} FROM z JOIN g USING (id) JOIN n o ON o.stix_id = actor GROUP BY id, tids"""
_GEN = [(2, "R02_actor_arsenal", 100), (7, "R07_mitigations", 100), (13, "R13_software_overviews", None)]
SQL["R15_U02_X08_generate"] = (
    "WITH "
    + ", ".join(f"g{k} AS (SELECT {k} AS category, * FROM ({SQL[name]})" + (f" ORDER BY md5(user_message), assistant_message LIMIT {most}" if most else "") + ")" for k, name, most in _GEN)
    + f", u AS (SELECT * FROM g2 UNION ALL SELECT * FROM g7 UNION ALL SELECT * FROM g13), h AS (SELECT *, {HASH_SQL} AS content_hash, {classify.domain_sql()} AS domain, {classify.question_type_sql()} AS question_type, row_number() OVER (PARTITION BY {HASH_SQL} ORDER BY category, user_message, assistant_message) AS i FROM u) SELECT category, user_message, domain, question_type, content_hash FROM h WHERE i = 1"
)

# SQL of the query builders: fields of an event as text, null where there are none.
_TABLE = "'| table _time, host, user, process_name, command_line, action, src_ip, dest_ip' || chr(10) || '| sort -_time'"


def _spl_sql(sourcetype, process, action, event_id):
    part = lambda name, x: f"coalesce('  {name}=\"' || {x} || '\"' || chr(10), '')"
    return f"'index=main sourcetype=\"' || {sourcetype} || '\"' || chr(10) || {part('process_name', process)} || {part('action', action)} || {part('event_id', event_id)} || {_TABLE}"


def _kql_sql(process, action, event_id):
    head, tail = "'| where TimeGenerated > ago(1h)' || chr(10)", "'| sort by TimeGenerated desc'"
    part = lambda text, x: f"coalesce('| where {text} \"' || {x} || '\"' || chr(10), '')"
    return f"CASE WHEN {process} IS NOT NULL THEN 'DeviceProcessEvents' || chr(10) || {head} || {part('FileName ==', process)} || {tail} ELSE 'SecurityEvent' || chr(10) || {head} || {part('Activity contains', action)} || {part('EventID ==', event_id)} || {tail} END"


def _correlation_sql(technique, types):
    return f"'index=main (' || {types} || ')' || chr(10) || '| eval technique=\"' || {technique} || '\"' || chr(10) || '| stats dc(sourcetype) as source_count, values(action) as actions by host' || chr(10) || '| where source_count >= 2'"


def _rule_sql(technique, title, fields):
    rid = " || '-' || ".join(f"substr(md5({technique}), {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'title: ' || {title} || chr(10) || 'id: ' || {rid} || chr(10) || 'status: experimental' || chr(10) || 'level: medium' || chr(10) || 'tags:' || chr(10) || '  - attack.' || lower({technique}) || chr(10) || 'detection:' || chr(10) || '  selection:' || chr(10) || {fields} || chr(10) || '  condition: selection'"


def _field_sql(name, x):
    return f"'    {name}: ' || chr(39) || {x} || chr(39)"


SQL["F48_F49_F50_F51_query_builders"] = f"""WITH v AS (SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN 'cmd.exe' END AS process, 'T' || (1000 + user_id % 700) AS t FROM events)
SELECT event_id, {_spl_sql("'wineventlog'", 'process', 'event_type', 'CAST(NULL AS VARCHAR)')} AS spl, {_kql_sql('process', 'event_type', 'CAST(NULL AS VARCHAR)')} AS kql, {_correlation_sql('t', "'sourcetype=' || chr(34) || 'a' || chr(34) || ' OR sourcetype=' || chr(34) || 'b' || chr(34)")} AS correlation, {_rule_sql('t', 'event_type', _field_sql('action', 'event_type') + " || coalesce(chr(10) || " + _field_sql('process_name', 'process') + ", '')")} AS rule FROM v"""
_STEPS = "CASE WHEN severity = 'high' THEN '- Escalate to incident response' || chr(10) ELSE '' END || CASE tactic WHEN 'Execution' THEN '- Stop the process and collect its memory' ELSE '- Isolate affected systems and restore from backups' END || chr(10) || '- Preserve the logs' || chr(10) || '- Document the findings'"
_LOG_EVENTS = """WITH l AS (SELECT 'T' || (1000 + k) AS t, k, 'Technique ' || k || ' (T' || (1000 + k) || ')' AS head, CASE WHEN k % 2 = 0 THEN 'Execution' ELSE 'Impact' END AS tactic, CASE WHEN k % 3 = 0 THEN 'high' ELSE 'low' END AS severity, s, min(CAST(event_id % 50 AS VARCHAR)) AS eid FROM (SELECT user_id % 40 AS k, event_type AS s, event_id FROM events) GROUP BY k, s),
x AS (SELECT *, '{"action":"' || s || '","event_id":"' || eid || '","label":"bad"}' AS shown FROM l), m AS (SELECT t, any_value(head) AS head, any_value(tactic) AS tactic, string_agg(s, ', ' ORDER BY s) AS sources, string_agg('sourcetype="st:' || s || '"', ' OR ' ORDER BY s) AS types, string_agg(i || '. ' || s || ': ' || shown, chr(10) ORDER BY s) AS listed FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY s) AS i FROM x) GROUP BY t HAVING count(*) >= 2) """
SQL["R26_R27_R28_R29_R30_R31_R32_R33_R36_log_pairs"] = _LOG_EVENTS + " UNION ALL ".join((
    f"SELECT 'log_analysis' AS kind, 'Analyze the following log:' || chr(10) || '```json' || chr(10) || shown || chr(10) || '```' AS user_message, 'The event shows ' || head || '. It belongs to the tactic ' || tactic || '. It was seen in ' || s || ' logs.' || chr(10) || 'Severity: ' || severity || chr(10) || 'Response:' || chr(10) || {_STEPS} AS assistant_message FROM x",
    "SELECT 'triage', 'Triage this alert:' || chr(10) || shown, 'Verdict: malicious, ' || head || chr(10) || 'Severity: ' || severity || chr(10) || 'Tactic: ' || tactic FROM x",
    f"SELECT 'spl_query', 'Write a Splunk detection query for ' || head || '.', '```spl' || chr(10) || {_spl_sql(chr(39) + 'st:' + chr(39) + ' || s', 'CAST(NULL AS VARCHAR)', 's', 'eid')} || chr(10) || '```' || chr(10) || 'Technique: ' || head FROM x",
    f"SELECT 'kql_query', 'Write a KQL query for ' || head || '.', '```kql' || chr(10) || {_kql_sql('CAST(NULL AS VARCHAR)', 's', 'eid')} || chr(10) || '```' || chr(10) || 'Technique: ' || head FROM x",
    f"SELECT 'sigma_write', 'Write a Sigma rule for ' || head || '.', '```yaml' || chr(10) || {_rule_sql('t', chr(39) + 'Technique ' + chr(39) + ' || k', ' || chr(10) || '.join((_field_sql('action', 's'), _field_sql('event_id', 'eid'), _field_sql('label', chr(39) + 'bad' + chr(39)))))} || chr(10) || '```' FROM x",
    "SELECT 'log_correlation', 'Correlate these security events from different sources:' || chr(10) || listed, 'Together they show ' || head || '.' || chr(10) || 'Sources: ' || sources || chr(10) || 'Tactic: ' || tactic FROM m",
    f"SELECT 'correlation_search', 'Write a correlation search for ' || head || '.', '```spl' || chr(10) || {_correlation_sql('t', 'types')} || chr(10) || '```' FROM m",
))
_PURPOSE = "CASE p_size % 3 WHEN 0 THEN 'Detects brute force attacks by failed logins.' WHEN 1 THEN 'Implements detection logic for: New service seen.' ELSE 'Implements detection logic for: Odd thing.' END || ' Applies a threshold.'"
SQL["F34_F35_explain"] = f"SELECT p_partkey, {_PURPOSE} AS explanation FROM part"
SQL["R38_R39_R40_search_pairs"] = f"""WITH s AS (SELECT p_partkey, p_size, CASE p_size % 3 WHEN 0 THEN 'Brute force on vpn' WHEN 1 THEN 'New service seen' ELSE 'Odd thing' END AS t, {search_queries._QUERY} AS q, p_name FROM part), h AS (SELECT *, {search.hint_sql('t', 'q')} AS hint, '```spl' || chr(10) || q || chr(10) || '```' AS fenced FROM s)
SELECT 'spl_query' AS kind, 'Write a Splunk search for: ' || t AS user_message, substring(fenced || chr(10) || {_PURPOSE} || coalesce(chr(10) || 'ATT&CK: ' || hint, '') || chr(10) || 'Schedule: every 5 minutes', 1, 2000) AS assistant_message FROM h
UNION ALL SELECT 'spl_explain', 'Explain this Splunk search:' || chr(10) || fenced, 'Query Breakdown:' || chr(10) || '1. **Base search:** `index=main x=' || p_name || '`' || chr(10) || '2. **`stats`:** ' || '{search.COMMANDS["stats"]}' || chr(10) || '3. **`where`:** ' || '{search.COMMANDS["where"]}' || chr(10) || '4. **`search`:** ' || '{search.COMMANDS["search"]}' || chr(10) || '5. **`STATS`:** Processes events with `STATS`' || chr(10) || 'Commands: index=main, stats, where, tool' FROM h"""
