"""Queries over functions, records, validation, cleaning and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from orefold.functions import classify, ids
from orefold.functions import text as tx
from orefold.operators import linking, records, sampling, validate
from orefold.plans.views import view, with_views

WHITE_SQL = tx.WHITE
HASH_SQL = f"sha256(trim(regexp_replace(lower(user_message || ' ' || assistant_message), '{WHITE_SQL}', ' ', 'g')))"
Q, SQL = {}, {}


def add(name, sql=None):
    def keep(f):
        Q[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def ids_sql(text, pattern):
    return f"nullif(array_to_string(list_sort(list_distinct(regexp_extract_all({text}, '{pattern}'))), ','), '')"


META_SQL = f"""r AS (SELECT id, user_message, assistant_message, {classify.domain_sql()} AS domain, {classify.question_type_sql()} AS question_type,
 {ids_sql("(user_message || ' ' || assistant_message)", tx.CVE)} AS cve_ids, {ids_sql("(user_message || ' ' || assistant_message)", tx.TECHNIQUE)} AS mitre_techniques, {ids_sql("(user_message || ' ' || assistant_message)", tx.CWE)} AS cwe_ids,
 coalesce(nullif(upper(regexp_extract(assistant_message, '(?i)Severity:\\s*(CRITICAL|HIGH|MEDIUM|LOW)', 1)), ''), CASE WHEN upper(regexp_extract(assistant_message, '(?i)Severity\\s*:\\s*(\\w+)', 1)) IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW') THEN upper(regexp_extract(assistant_message, '(?i)Severity\\s*:\\s*(\\w+)', 1)) END) AS severity,
 TRY_CAST(regexp_extract(assistant_message, '(?i)(?:CVSS\\s+)?base\\s+score:\\s*([\\d.]+)', 1) AS DOUBLE) AS cvss_score,
 length(user_message || ' ' || assistant_message) AS char_length, {HASH_SQL} AS content_hash FROM v_records)"""
META = with_views("v_records").rstrip() + ", " + META_SQL + " "
#: Records as stored: scores and states derived from the key, so every filter has rows on either side.
STORED_SQL = META_SQL + ", s AS (SELECT *, CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(id % 9 AS DOUBLE) / 2 + 0.5 END AS quality_score, CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN 'fail' WHEN id % 5 = 2 THEN 'warn' ELSE 'pass' END AS validation_status FROM r)"
STORED = with_views("v_records").rstrip() + ", " + STORED_SQL + " "


def meta(spark, d):
    return records.with_metadata(view(spark, d, "v_records"))


def stored(spark, d):
    k = F.col("id")
    return meta(spark, d).withColumns({
        "quality_score": F.when(k % 3 != 0, (k % 9).cast("double") / 2 + 0.5),
        "validation_status": F.when(k % 5 == 0, None).when(k % 5 == 1, "fail").when(k % 5 == 2, "warn").otherwise("pass"),
    })


@add("P01_message_pivot", with_views("v_pairs") + "SELECT * FROM v_pairs")
def _(spark, d):
    return records.pairs_of_turns(spark.read.parquet(f"{d}/conversations.parquet"))


@add("F01_content_hash", with_views("v_pairs") + f"SELECT conv_id, {HASH_SQL} AS content_hash FROM v_pairs")
def _(spark, d):
    return view(spark, d, "v_pairs").select("conv_id", tx.content_hash(F.col("user_message"), F.col("assistant_message")).alias("content_hash"))


@add("F02_F03_F04_identifiers", META + "SELECT id, cve_ids, mitre_techniques, cwe_ids FROM r")
def _(spark, d):
    return meta(spark, d).select("id", "cve_ids", "mitre_techniques", "cwe_ids")


@add("F05_F06_severity_and_score", META + "SELECT id, severity, cvss_score FROM r")
def _(spark, d):
    return meta(spark, d).select("id", "severity", "cvss_score")


@add("F07_classify_record", META + "SELECT id, domain FROM r")
def _(spark, d):
    return meta(spark, d).select("id", "domain")


@add("F08_question_type", META + "SELECT id, question_type FROM r")
def _(spark, d):
    return meta(spark, d).select("id", "question_type")


@add("F09_all_metadata", META + "SELECT id, domain, question_type, cve_ids, mitre_techniques, cwe_ids, severity, cvss_score, CAST(char_length AS INT) AS char_length, content_hash FROM r")
def _(spark, d):
    return meta(spark, d).drop("user_message", "assistant_message")


@add("F11_strip_artifacts", "SELECT doc_id, md5(array_to_string(list_transform(string_split('> ' || replace(text, '. ', chr(10) || '* **'), chr(10)), lambda x: regexp_replace(x, '^(?:[>*]{1,2}\\s*)+', '')), chr(10))) AS h FROM documents WHERE text IS NOT NULL")
def _(spark, d):
    t = F.concat(F.lit("> "), F.replace("text", F.lit(". "), F.lit("\n* **")))
    return spark.read.parquet(f"{d}/documents.parquet").where("text IS NOT NULL").select("doc_id", F.md5(tx.strip_artifacts(t).cast("binary")).alias("h"))


_FORMATTED = "'<|assistant|>' || chr(10) || 'T' || CAST(1000 + o_orderkey % 700 AS VARCHAR(10)) || CASE WHEN o_orderkey % 2 = 0 THEN '.001' ELSE '' END || ' | ' || lower(o_orderpriority) || ' | ' || CAST(o_custkey % 101 AS VARCHAR(10)) || '% | ' || o_orderstatus || ' seen  <|eot_id|> rest'"


def formatted(spark, d):
    n = lambda c: c.cast("string")
    k = F.col("o_orderkey")
    t = F.concat(F.lit("<|assistant|>\nT"), n(1000 + k % 700), F.when(k % 2 == 0, ".001").otherwise(""), F.lit(" | "), F.regexp_replace(F.lower("o_orderpriority"), "[^a-z ]", ""), F.lit(" | "), n(F.col("o_custkey") % 101), F.lit("% | "), F.col("o_orderstatus"), F.lit(" seen  <|eot_id|> rest"))
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", t.alias("text"))


_FORMATTED = _FORMATTED.replace("lower(o_orderpriority)", "regexp_replace(lower(o_orderpriority), '[^a-z ]', '', 'g')")


@add("F10_F12_response_and_tokens", f"SELECT o_orderkey, trim(split_part(split_part(t, '<|assistant|>' || chr(10), 2), '<|eot_id|>', 1)) AS response, CAST(len(list_filter(string_split_regex(trim(split_part(split_part(t, '<|assistant|>' || chr(10), 2), '<|eot_id|>', 1)), '\\s+'), lambda w: w <> '')) AS INT) AS tokens FROM (SELECT o_orderkey, {_FORMATTED} AS t FROM orders)")
def _(spark, d):
    return formatted(spark, d).select("o_orderkey", tx.response(F.col("text")).alias("response"), tx.token_count(F.col("text")).alias("tokens"))


@add("F14_F15_F16_parse_prediction", f"SELECT o_orderkey, 'T' || regexp_extract(t, '(?i)T(\\d{{4}}(?:\\.\\d{{3}})?)\\s*\\|\\s*(\\w[\\w ]*?)\\s*\\|', 1) AS technique_id, trim(regexp_extract(t, 'T\\d{{4}}(?:\\.\\d{{3}})? \\| *(\\w[\\w ]*?) *\\|', 1)) AS tactic, CAST(regexp_extract(t, '(\\d+)%', 1) AS INT) AS confidence, o_orderstatus || ' seen   rest' AS explanation FROM (SELECT o_orderkey, o_orderstatus, {_FORMATTED} AS t FROM orders) WHERE regexp_matches(t, '\\| *\\w[\\w ]*? *\\|')")
def _(spark, d):
    return formatted(spark, d).select("o_orderkey", tx.ground_truth(F.col("text")).alias("p")).where("p IS NOT NULL").select("o_orderkey", "p.*")


ACTIONS = ["NONE", "UP", "DOWN", "LEFT", "RIGHT"]


@add("F17_F36_actions", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 'DOWN' WHEN l_linenumber % 3 = 1 THEN 'LEFT' END AS action, CASE WHEN l_linenumber % 3 = 0 THEN 2 WHEN l_linenumber % 3 = 1 THEN 3 ELSE 0 END AS action_id FROM lineitem")
def _(spark, d):
    k = F.col("l_linenumber")
    t = F.when(k % 3 == 0, "I choose. action: down").when(k % 3 == 1, "go left or up, Action: jump").otherwise("leftover upper")
    a = tx.action_of(t, ACTIONS)
    return spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", a.alias("action"), tx.action_id(a, ACTIONS).alias("action_id"))


_WS = "'^\\s+|\\s+$'"


@add("F18_strip_html", f"SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '(?i)<li\\s*>', '- ', 'g'), '(?i)<p\\s*>', chr(10), 'g'), '<[^>]+>', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), {_WS}, '', 'g')) AS h FROM pages")
def _(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", F.md5(tx.strip_html(F.col("html")).cast("binary")).alias("h"))


@add("F19_severity_of_score", "SELECT o_orderkey, CASE WHEN s >= 9 THEN 'CRITICAL' WHEN s >= 7 THEN 'HIGH' WHEN s >= 4 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM (SELECT o_orderkey, CAST(o_custkey % 101 AS DOUBLE) / 10 AS s FROM orders)")
def _(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", tx.severity_of_score((F.col("o_custkey") % 101).cast("double") / 10).alias("severity"))


@add("F20_F21_cut_and_first_sentence", "SELECT doc_id, md5(CASE WHEN length(text) > 2000 THEN regexp_replace(substring(text, 1, 2000), '\\.[^.]*$', '') || '.' ELSE text END) AS cut, md5(rtrim(split_part(text, '. ', 1), '.')) AS first FROM documents")
def _(spark, d):
    t = F.col("text")
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.md5(tx.cut_at_sentence(t).cast("binary")).alias("cut"), F.md5(tx.first_sentence(t).cast("binary")).alias("first"))


_RULE = "'title: x' || chr(10) || 'status: ' || CASE WHEN p_size % 5 = 0 THEN 'stable' WHEN p_size % 5 = 1 THEN 'test' WHEN p_size % 5 = 2 THEN 'odd' ELSE 'experimental' END || chr(10) || 'level: ' || CASE WHEN p_size % 3 = 0 THEN 'high' WHEN p_size % 3 = 1 THEN 'low' ELSE 'critical' END || chr(10) || 'tags:' || chr(10) || '  - attack.t' || CAST(1000 + p_partkey % 9000 AS VARCHAR(10)) || chr(10) || '  - attack.execution' || chr(10) || 'detection: y'"


@add("F24_F25_F26_rules", f"SELECT p_partkey, 'T' || regexp_extract(r, 'attack.t(\\d{{4}})', 1) AS technique, regexp_extract(r, 'status: (\\w+)', 1) AS status, regexp_extract(r, 'level: (\\w+)', 1) AS level, CAST(CASE regexp_extract(r, 'status: (\\w+)', 1) WHEN 'stable' THEN 0 WHEN 'test' THEN 1 WHEN 'experimental' THEN 2 ELSE 5 END * 10 + CASE regexp_extract(r, 'level: (\\w+)', 1) WHEN 'critical' THEN 0 WHEN 'high' THEN 1 ELSE 3 END AS INT) AS score FROM (SELECT p_partkey, {_RULE} AS r FROM part)")
def _(spark, d):
    s, number = F.col("p_size"), 1000 + F.col("p_partkey") % 9000
    rule = F.concat(F.lit("title: x\nstatus: "), F.when(s % 5 == 0, "stable").when(s % 5 == 1, "test").when(s % 5 == 2, "odd").otherwise("experimental"), F.lit("\nlevel: "), F.when(s % 3 == 0, "high").when(s % 3 == 1, "low").otherwise("critical"), F.lit("\ntags:\n  - attack.t"), number.cast("string"), F.lit("\n  - attack.execution\ndetection: y"))
    df = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", rule.alias("r"))
    r = F.col("r")
    status, level = tx.rule_field(r, "status", "experimental"), tx.rule_field(r, "level", "medium")
    return df.select("p_partkey", tx.rule_techniques(r)[0].alias("technique"), status.alias("status"), level.alias("level"), tx.rule_score(status, level).cast("int").alias("score"))


@add("F39_uuid5", "SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(CAST('0x' || substr(h, 17, 1) AS INT) % 4 + 1 AS INT), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM (SELECT o_orderkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('CVE-' || CAST(o_orderkey AS VARCHAR(20)))) AS h FROM orders)")
def _(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", ids.uuid5(F.concat(F.lit("CVE-"), F.col("o_orderkey").cast("string"))).alias("uuid"))


@add("U12_template_choice", "SELECT c_custkey, " + ", ".join(f"CAST(('0x' || md5(c_name))::UHUGEINT % {n} AS INT) AS t{n}" for n in (3, 4, 5)) + " FROM customer")
def _(spark, d):
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", *(ids.md5_choice(F.col("c_name"), n).alias(f"t{n}") for n in (3, 4, 5)))


@add("J22_K01_dedup_new", META + "SELECT min(id) AS id, content_hash FROM r WHERE content_hash NOT IN (SELECT content_hash FROM r WHERE id % 7 = 0) GROUP BY content_hash")
def _(spark, d):
    rows = meta(spark, d).select("id", "content_hash")
    return records.dedup_new(rows, rows.where("id % 7 = 0"))


@add("K03_upsert", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 4 <> 0 UNION ALL SELECT c_custkey, max_by(v, o) FROM (SELECT c_custkey, 'new' || CAST(k AS VARCHAR(2)) AS v, k AS o FROM customer, (SELECT 1 AS k UNION ALL SELECT 2) WHERE c_custkey % 4 = 0) GROUP BY c_custkey")
def _(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_mktsegment")
    new = c.where("c_custkey % 4 = 0").withColumn("o", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("c_mktsegment", F.concat(F.lit("new"), F.col("o").cast("string")))
    return records.upsert(c, new, "c_custkey", "o")


@add("K08_K09_write_back", STORED + "SELECT id, CASE WHEN id % 4 = 0 THEN 5.0 ELSE quality_score END AS quality_score FROM s")
def _(spark, d):
    s = stored(spark, d).select("id", "quality_score")
    return records.write_back(s, s.where("id % 4 = 0").select("id", F.lit(5.0).alias("quality_score")), "id", ["quality_score"])


_PASS = "(validation_status <> 'fail' OR validation_status IS NULL) AND (quality_score >= 3.5 OR quality_score IS NULL)"


@add("P02_exportable", STORED + f"SELECT id, domain, quality_score FROM s WHERE {_PASS}")
def _(spark, d):
    return records.exportable(stored(spark, d)).select("id", "domain", "quality_score")


@add("P03_reviewable", STORED + "SELECT id FROM s WHERE quality_score IS NULL AND domain = 'cve' AND (validation_status = 'pass' OR validation_status IS NULL)")
def _(spark, d):
    return records.reviewable(stored(spark, d), domain="cve").select("id")


@add("O01_quality_order", STORED + "SELECT id, row_number() OVER (PARTITION BY domain ORDER BY coalesce(quality_score, 3.0) DESC, id) AS rank FROM s")
def _(spark, d):
    return stored(spark, d).select("id", F.row_number().over(Window.partitionBy("domain").orderBy(*records.quality_order())).alias("rank"))


@add("A01_domain_stats", STORED + ", d AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in classify.DOMAINS) + "]) AS domain) SELECT d.domain, count(id) AS record_count, coalesce(avg(char_length), 0.0) AS avg_length, count(cve_ids) AS total_cves, count(mitre_techniques) AS total_techniques, " + ", ".join(f"count(*) FILTER (WHERE severity = '{x}') AS severity_{x.lower()}" for x in tx.SEVERITIES) + ", count(validation_status) AS validated_count, count(*) FILTER (WHERE validation_status = 'pass') AS validation_pass_count, count(*) FILTER (WHERE validation_status = 'fail') AS validation_fail_count, avg(quality_score) AS avg_quality_score FROM d LEFT JOIN s USING (domain) GROUP BY d.domain")
def _(spark, d):
    return records.domain_stats(stored(spark, d))


@add("A30_export_counts", STORED + f"SELECT domain, count(*) AS n FROM s WHERE {_PASS} GROUP BY domain")
def _(spark, d):
    return records.exportable(stored(spark, d)).groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


def _contains_any(text, words):
    return "(" + " OR ".join(f"contains({text}, '{w.replace(chr(39), chr(39) * 2)}')" for w in words) + ")"


_V = validate
_SHORT = "length(regexp_replace(assistant_message, '^\\s+|\\s+$', '', 'g'))"
_LOW = "lower(assistant_message)"
_BANDS = " OR ".join(f"(severity = '{k}' AND NOT cvss_score BETWEEN {lo} AND {hi})" for k, (lo, hi) in _V.BANDS.items())
_BOTH_SQL = "(user_message || ' ' || assistant_message)"


def _checks_sql():
    rows = []

    def rule(domain, check, severity, cond):
        rows.append(f"SELECT id, '{check}' AS c, '{severity}' AS v FROM r WHERE domain = '{domain}' AND ({cond})")

    for dom, n in _V.SHORTEST.items():
        rule(dom, "response_too_short", "error", f"{_SHORT} < {n}")
    rows.append("SELECT id, 'cve_id_format', 'error' FROM (SELECT id, unnest(string_split(cve_ids, ',')) AS x FROM r WHERE domain = 'cve') WHERE NOT regexp_matches(x, '^CVE-\\d{4}-\\d{4,}$')")
    rule("cve", "cvss_range", "error", "NOT cvss_score BETWEEN 0 AND 10")
    rule("cve", "severity_cvss_mismatch", "warn", _BANDS)
    rule("cve", "question_response_align", "warn", f"question_type = 'impact' AND NOT {_contains_any(_LOW, ('impact', 'affect'))}")
    rule("cve", "question_response_align", "warn", f"question_type = 'mitigation' AND NOT {_contains_any(_LOW, _V.MITIGATION_WORDS)}")
    rule("mitre_attack", "missing_tactic", "warn", f"mitre_techniques IS NOT NULL AND NOT {_contains_any(f'lower({_BOTH_SQL})', _V.TACTICS)}")
    rule("secure_code_review", "missing_code_blocks", "warn", "NOT regexp_matches(assistant_message, '(?s)```.*?```|    \\S')")
    rule("secure_code_review", "missing_security_context", "warn", f"NOT {_contains_any(_LOW, _V.SECURITY_WORDS)}")
    rule("apt_intel", "missing_group_identity", "warn", "NOT regexp_matches(assistant_message, '\\bG\\d{4}\\b|APT\\d+|(?i)(?:Also known as|Attribution|tracked|associated with)\\b')")
    rule("apt_intel", "low_specificity", "warn", f"NOT (regexp_matches(assistant_message, '[TSC]\\d{{4}}|\\bG\\d{{4}}\\b') OR {_contains_any(_LOW, _V.SPECIFIC_WORDS)})")
    rule("log_analysis", "missing_embedded_log", "error", "NOT (contains(user_message, '```') OR contains(user_message, '{'))")
    rule("log_analysis", "missing_technique_id", "warn", "NOT regexp_matches(assistant_message, 'T\\d{4}')")
    rule("log_analysis", "missing_severity", "warn", f"NOT {_contains_any(_LOW, _V.SEVERITY_WORDS)}")
    rule("siem_queries", "missing_code_block", "error", "NOT (" + _contains_any("assistant_message", ("```", "Query Breakdown", "Base search")) + " OR regexp_matches(assistant_message, '\\|\\s*(stats|eval|table|where|search|rename|tstats|streamstats|timechart|chart)'))")
    rule("siem_queries", "missing_query_syntax", "warn", f"NOT {_contains_any(_BOTH_SQL, _V.SPL_WORDS + _V.KQL_WORDS)}")
    rule("sigma_rules", "missing_yaml_structure", "warn", "(" + " + ".join(f"CAST(contains(assistant_message, '{m}') AS INT)" for m in _V.YAML_MARKERS) + f") < 2 AND NOT {_contains_any(_LOW, _V.EXPLAINING_WORDS)}")
    rule("security_general", "generic_filler", "error", " OR ".join(f"regexp_matches(regexp_replace(assistant_message, '^\\s+|\\s+$', '', 'g'), '{p.replace(chr(39), chr(39) * 2)}')" for p in _V.FILLERS))
    return META.rstrip() + ", c(id, c, v) AS (" + " UNION ALL ".join(rows) + "), a AS (SELECT r.id, r.domain, CASE WHEN bool_or(v = 'error') THEN 'fail' WHEN bool_or(v = 'warn') THEN 'warn' ELSE 'pass' END AS validation_status, coalesce(array_to_string(list_sort(list(c.c) FILTER (WHERE c.c IS NOT NULL)), ','), '') AS checks FROM r LEFT JOIN c USING (id) GROUP BY 1, 2) "


@add("V01_V10_validate", _checks_sql() + "SELECT id, validation_status, checks FROM a")
def _(spark, d):
    v = validate.validate(meta(spark, d))
    return v.select("id", "validation_status", F.array_join(F.array_sort(F.transform("validation_errors", lambda e: e["check"])), ",").alias("checks"))


@add("A05_V11_validation_rollup", _checks_sql() + "SELECT 'status' AS level, NULL AS domain, validation_status AS name, count(*) AS n FROM a GROUP BY 3 UNION ALL SELECT 'check', NULL, c, count(*) FROM c GROUP BY 3 UNION ALL SELECT 'domain_check', domain, c, count(*) FROM c JOIN r USING (id) GROUP BY 2, 3")
def _(spark, d):
    return validate.rollup(validate.validate(meta(spark, d)))


@add("V12_K07_length_flags", with_views("v_docs") + "SELECT doc_id, CASE WHEN (quality_score IS NULL OR quality_score <> 0) AND (length(text) < 500 OR length(text) > 3000) THEN 'fail' WHEN quality_score = 0 THEN 'fail' WHEN quality_score = 1 THEN 'pass' END AS status, CASE WHEN quality_score = 0 THEN 'old' WHEN length(text) < 500 THEN 'response_too_short' WHEN length(text) > 3000 THEN 'response_too_long' END AS chk FROM v_docs")
def _(spark, d):
    q = F.col("quality_score")
    old = F.array(F.struct(F.lit("old").alias("check"), F.lit("error").alias("severity"), F.lit("").alias("msg")))
    df = view(spark, d, "v_docs").select("doc_id", "text", F.when(q == 0, "fail").when(q == 1, "pass").alias("s"), F.when(q == 0, old).alias("e"))
    status, errors = validate.length_flags(F.col("text"), F.col("s"), F.col("e"), 500, 3000)
    return df.select("doc_id", status.alias("status"), F.get(errors, F.lit(0))["check"].alias("chk"))


@add("W09_first_by_normal_text", with_views("v_docs") + f"SELECT min(doc_id) AS doc_id FROM v_docs GROUP BY lower(trim(regexp_replace(text, '{WHITE_SQL}', ' ', 'g')))")
def _(spark, d):
    return records.first_by_normal_text(view(spark, d, "v_docs"), F.col("text"), "doc_id").select("doc_id")


WEIGHTS = {"cve": 0.25, "apt_intel": 2.5, "log_analysis": 3.0, "stix_general": 0.0001}
_W = "CASE domain " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.items()) + " ELSE 1.0 END"


@add("U06_W03_domain_weights", STORED + f""", k AS (SELECT id, domain, count(*) OVER (PARTITION BY domain) AS n, row_number() OVER (PARTITION BY domain ORDER BY coalesce(quality_score, 3.0) DESC, id) AS rank, row_number() OVER (PARTITION BY domain ORDER BY md5('42:' || CAST(id AS VARCHAR(20))), id) AS draw, CAST({_W} AS DOUBLE) AS w FROM s),
c AS (SELECT id, CASE WHEN w < 1 THEN CAST(rank <= greatest(1, floor(n * w)) AS INT) ELSE CAST(floor(w) AS INT) + CAST(draw <= floor(n * (w - floor(w))) AS INT) END AS copies FROM k) SELECT id, CAST(copy_no AS INT) AS copy_no, md5('42:' || CAST(id AS VARCHAR(20)) || ':' || CAST(copy_no AS VARCHAR(5))) AS shuffle_key FROM (SELECT id, unnest(range(1, copies + 1)) AS copy_no FROM c)""")
def _(spark, d):
    return sampling.domain_weights(stored(spark, d), WEIGHTS).select("id", "copy_no", "shuffle_key")


_BUCKET = "CAST('0x' || substr(md5('42:' || content_hash), 1, 12) AS BIGINT) % 10000"


@add("U09_ratio_split", META + f"SELECT id, CASE WHEN b < 9000 THEN 'train' WHEN b < 9500 THEN 'validation' ELSE 'test' END AS split FROM (SELECT id, {_BUCKET} AS b FROM r)")
def _(spark, d):
    return sampling.ratio_split(meta(spark, d), "content_hash", {"train": 0.9, "validation": 0.05, "test": 0.05}).select("id", "split")


@add("U10_U11_positional_split", "SELECT event_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || CAST(event_id AS VARCHAR(20))), event_id) <= floor(count(*) OVER () * 0.1) THEN 'test' ELSE 'train' END AS split FROM events")
def _(spark, d):
    return sampling.positional_split(spark.read.parquet(f"{d}/events.parquet").select("event_id"), "event_id", 0.1)


@add("O03_U21_review_sample", META + "SELECT id FROM r ORDER BY md5('42:' || CAST(id AS VARCHAR(20))), id LIMIT 100")
def _(spark, d):
    return sampling.review_sample(meta(spark, d).select("id"), 100)


FRAMES = with_views("v_frames")


@add("W01_decision_points", FRAMES + "SELECT episode_id, frame_index, coalesce(lag(action_label) OVER (PARTITION BY episode_id ORDER BY frame_index) <> action_label, true) AS is_decision FROM v_frames")
def _(spark, d):
    return sampling.decision_points(view(spark, d, "v_frames")).select("episode_id", "frame_index", "is_decision")


@add("W02_P17_sampled_frames", FRAMES + "SELECT episode_id, frame_index FROM (SELECT *, lag(action_label) OVER (PARTITION BY episode_id ORDER BY frame_index) AS b FROM v_frames) WHERE coalesce(b <> action_label, true) OR reward - 80 > 0 OR frame_index % 4 = 0")
def _(spark, d):
    return sampling.sampled_frames(view(spark, d, "v_frames").withColumn("reward", F.col("reward") - 80), 4).select("episode_id", "frame_index")


@add("U07_balanced_actions", FRAMES + """, t AS (SELECT episode_id, frame_index, action_label, coalesce(lag(action_label) OVER (PARTITION BY episode_id ORDER BY frame_index) <> action_label, true) AS dec FROM v_frames),
i AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(episode_id AS VARCHAR(20)) || ':' || CAST(frame_index AS VARCHAR(20))), CAST(episode_id AS VARCHAR(20)) || ':' || CAST(frame_index AS VARCHAR(20))) AS rk FROM t WHERE action_label = 'NONE' AND NOT dec)
SELECT episode_id, frame_index, CAST(unnest(range(1, CASE WHEN dec THEN 4 ELSE 2 END)) AS INT) AS copy_no FROM t WHERE action_label <> 'NONE' UNION ALL SELECT episode_id, frame_index, 1 FROM t WHERE action_label = 'NONE' AND dec
UNION ALL SELECT episode_id, frame_index, 1 FROM i WHERE rk <= greatest(0, floor((SELECT count(*) FROM t) * 0.25) - (SELECT count(*) FROM t WHERE action_label = 'NONE' AND dec))""")
def _(spark, d):
    return sampling.balanced_actions(view(spark, d, "v_frames")).select("episode_id", "frame_index", "copy_no")


@add("W08_U08_episode_split", FRAMES + ", e AS (SELECT episode_id, count(*) AS n FROM v_frames GROUP BY 1), c AS (SELECT episode_id, coalesce(sum(n) OVER (ORDER BY md5('42:' || CAST(episode_id AS VARCHAR(20))), episode_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM e) SELECT episode_id, frame_index, CASE WHEN b < (SELECT count(*) FROM v_frames) * 0.1 THEN 'test' ELSE 'train' END AS split FROM v_frames JOIN c USING (episode_id)")
def _(spark, d):
    return sampling.episode_split(view(spark, d, "v_frames")).select("episode_id", "frame_index", "split")


@add("N02_distinct_aliases", "SELECT o_custkey, list_filter(a, lambda x, i: lower(x) <> 'x1' AND list_position(list_transform(a, lambda y: lower(y)), lower(x)) = i) AS aliases FROM (SELECT o_custkey, list('X' || CAST(o_orderkey % 5 AS VARCHAR(5)) ORDER BY o_orderkey) || ['x2', 'X7'] AS a FROM orders GROUP BY o_custkey)")
def _(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey"))).alias("k"))
    a = F.concat(F.transform("k", lambda x: F.concat(F.lit("X"), (x["o_orderkey"] % 5).cast("string"))), F.array(F.lit("x2"), F.lit("X7")))
    return rows.select("o_custkey", linking.distinct_aliases(F.lit("x1"), a).alias("aliases"))


@add("N14_errors_json")
def _(spark, d):
    j = validate.errors_json(F.col("validation_errors"))
    return validate.validate(meta(spark, d)).select("id", j.isNull().alias("clean"), F.coalesce(F.json_array_length(j), F.lit(0)).cast("long").alias("n"))


@add("A25_N15_mean_review_score", "SELECT l_orderkey, l_linenumber, (l_linenumber % 6 + coalesce(CASE WHEN l_quantity % 2 = 0 THEN 5 END, 3) + 3 + 4 + 5) / 5.0 AS score FROM lineitem")
def _(spark, d):
    s = F.struct((F.col("l_linenumber") % 6).alias("accuracy"), F.when(F.col("l_quantity") % 2 == 0, 5).alias("completeness"), F.lit(None).cast("int").alias("clarity"), F.lit(4).alias("relevance"), F.lit(5).alias("usefulness"))
    return spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", records.mean_review_score(s).alias("score"))
