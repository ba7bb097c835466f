"""Derived tables over the driver's tables, as SQL that Spark and other engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "pages", "conversations")

VIEWS: dict[str, str] = {
    "v_pairs": """
SELECT conv_id, max_by(text, turn) FILTER (WHERE role='user') AS user_message, max_by(text, turn) FILTER (WHERE role='assistant') AS assistant_message FROM conversations GROUP BY conv_id
""",
    "v_records": """
SELECT o_orderkey AS id,
 concat(CASE CAST(o_orderkey % 11 AS INT) WHEN 0 THEN 'Write a Sigma rule for ' WHEN 1 THEN 'Write a Splunk SPL query for ' WHEN 2 THEN 'Analyze the following log {} for ' WHEN 3 THEN 'Who is the threat actor behind ' WHEN 4 THEN 'Summarize CVE-' WHEN 5 THEN 'Describe the technique T' WHEN 6 THEN 'Is this code safe? ' WHEN 7 THEN 'ExploitDB entry ' WHEN 8 THEN 'STIX bundle ' WHEN 9 THEN 'How is CVE-2020-1 mitigated ' ELSE 'Best practice for ' END, CASE CAST(o_orderkey % 11 AS INT) WHEN 4 THEN concat(CAST(2000 + o_orderkey % 26 AS VARCHAR(10)), '-', CAST(1000 + o_orderkey % 9000 AS VARCHAR(10))) WHEN 5 THEN CAST(1000 + o_custkey % 700 AS VARCHAR(10)) ELSE o_orderpriority END) AS user_message,
 concat('Severity: ', CASE CAST(o_custkey % 5 AS INT) WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'high' WHEN 2 THEN 'Medium' WHEN 3 THEN 'LOW' ELSE 'n/a' END, CASE WHEN o_orderkey % 3 = 0 THEN concat(' CVSS base score: ', CAST(o_custkey % 11 AS VARCHAR(10)), '.5') ELSE '' END, CASE WHEN o_orderkey % 4 = 0 THEN concat(' CWE-', CAST(o_custkey % 900 AS VARCHAR(10))) ELSE '' END, CASE WHEN o_orderkey % 22 = 4 THEN concat(' Used with T', CAST(1000 + o_custkey % 700 AS VARCHAR(10))) ELSE '' END, ' ', o_orderstatus) AS assistant_message
FROM orders
""",
    "v_edges": """
SELECT DISTINCT concat('intrusion-set--', CAST(o_custkey AS VARCHAR(20))) AS src, concat('attack-pattern--', CAST(l_partkey AS VARCHAR(20))) AS dst, 'uses' AS rel_type FROM orders JOIN lineitem ON o_orderkey = l_orderkey
UNION ALL SELECT DISTINCT concat(CASE WHEN l_suppkey % 2 = 0 THEN 'malware--' ELSE 'tool--' END, CAST(l_suppkey AS VARCHAR(20))), concat('attack-pattern--', CAST(l_partkey AS VARCHAR(20))), 'uses' FROM lineitem
UNION ALL SELECT DISTINCT concat('intrusion-set--', CAST(o_custkey AS VARCHAR(20))), concat(CASE WHEN l_suppkey % 2 = 0 THEN 'malware--' ELSE 'tool--' END, CAST(l_suppkey AS VARCHAR(20))), 'uses' FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_linenumber = 1
UNION ALL SELECT concat('x-mitre-data-component--', CAST(r_regionkey AS VARCHAR(20))), concat('attack-pattern--', CAST(p_partkey AS VARCHAR(20))), 'detects' FROM region JOIN part ON p_size % 9 = r_regionkey
UNION ALL SELECT concat('campaign--', CAST(n_nationkey AS VARCHAR(20))), concat('intrusion-set--', CAST(c_custkey AS VARCHAR(20))), 'attributed-to' FROM nation JOIN customer ON n_nationkey = c_nationkey
UNION ALL SELECT concat('course-of-action--', CAST(r_regionkey AS VARCHAR(20))), concat('attack-pattern--', CAST(p_partkey AS VARCHAR(20))), 'mitigates' FROM region JOIN part ON p_size % 5 = r_regionkey
UNION ALL SELECT concat('attack-pattern--', CAST(p_partkey AS VARCHAR(20))), concat('attack-pattern--', CAST(p_partkey - p_partkey % 10 AS VARCHAR(20))), 'subtechnique-of' FROM part WHERE p_partkey % 10 <> 0 AND p_partkey > 10
""",
    "v_frames": """
SELECT user_id AS episode_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index, CASE WHEN event_type='view' THEN 'NONE' ELSE upper(event_type) END AS action_label, value AS reward FROM events
""",
    "v_nodes": """
SELECT concat('intrusion-set--', CAST(c_custkey AS VARCHAR(20))) AS stix_id, 'intrusion-set' AS type, c_name AS name, CAST(NULL AS INT) AS phase_no FROM customer
UNION ALL SELECT concat('attack-pattern--', CAST(p_partkey AS VARCHAR(20))), 'attack-pattern', p_name, p_size % 14 FROM part
UNION ALL SELECT concat(CASE WHEN s_suppkey % 2 = 0 THEN 'malware--' ELSE 'tool--' END, CAST(s_suppkey AS VARCHAR(20))), CASE WHEN s_suppkey % 2 = 0 THEN 'malware' ELSE 'tool' END, s_name, NULL FROM supplier
UNION ALL SELECT concat('campaign--', CAST(n_nationkey AS VARCHAR(20))), 'campaign', n_name, NULL FROM nation
UNION ALL SELECT concat('course-of-action--', CAST(r_regionkey AS VARCHAR(20))), 'course-of-action', r_name, NULL FROM region
UNION ALL SELECT concat('x-mitre-data-component--', CAST(r_regionkey AS VARCHAR(20))), 'x-mitre-data-component', concat('Component ', r_name), NULL FROM region
""",
    "v_docs": """
SELECT d.doc_id, d.text, d.lang, d.source, CAST(l.quality AS DOUBLE) AS quality_score FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""",
    "v_metrics": """
SELECT event_id AS seq, event_type AS event, value AS metric, user_id AS run_id FROM events
""",
    "v_preds": """
SELECT l_orderkey, l_linenumber, l_returnflag AS truth, CASE WHEN l_linenumber % 3 = 0 THEN l_linestatus ELSE l_returnflag END AS pred, l_discount * 10 AS confidence FROM lineitem
""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table; only the tables that its SQL names are read."""
    sql = VIEWS[name]
    for t in TABLES:
        if t in sql:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(sql)


def with_views(*names: str) -> str:
    """The head of a SQL query that uses derived tables."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names) + " "
