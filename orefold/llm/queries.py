"""Queries over the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.llm import bpe, decontamination, html_extraction, language_id, line_dedup, ngram_join, quality_rules, sharding, suffix_dedup, toxicity
from orefold.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "byte_bpe_50k.json") -> bpe.Vocabulary:
    """A vocabulary of the tokenizer files that this installation offers."""
    import public_tokenizers

    return bpe.Vocabulary(public_tokenizers.path(name))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, vocabulary(), decoded="decoded"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passage_words")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", F.transform("evidence", lambda e: e["example"]).alias("evidence"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.fit(docs))
    return found.select("doc_id", (language_id.fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.clean(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_language_id": op4_language_id,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_ngram_join": op7_ngram_join,
    "op8_decontamination": op8_decontamination,
    "op9_sharding": op9_sharding,
    "op10_html_extraction": op10_html_extraction,
}

_LINE_SQL = f"""
WITH l AS (SELECT doc_id, coalesce(source, chr(0) || 'null') AS site, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, site, line, line_no, nullif(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '') AS line_key FROM l),
b AS (SELECT line_key, min(struct_pack(d := doc_id, n := line_no)) AS first FROM k WHERE line_key IS NOT NULL GROUP BY 1 HAVING count(DISTINCT site) >= {line_dedup.MIN_SITES}),
j AS (SELECT k.*, b.first IS NOT NULL AND NOT (b.first.d = k.doc_id AND b.first.n = k.line_no) AS gone FROM k LEFT JOIN b USING (line_key)),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') AS kept FROM j GROUP BY 1)
"""

_QUALITY_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '[ \t-\r]+', '', 'g') <> '') AS ls FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY 1),
t AS (SELECT doc_id, trim(regexp_replace(unnest(ls), '[ \t-\r]+', ' ', 'g')) AS t FROM w),
m AS (SELECT doc_id, t, length(t) AS c, length(replace(t, ' ', '')) AS bare, len(string_split(t, ' ')) AS n, length(t) - length(translate(t, '#*$%&|<>', '')) AS y, len(list_filter(string_split(t, ' '), lambda x: x IN ('|', '>', '»', '·', '•', '/', '-', '–', '::'))) AS s FROM t),
f AS (SELECT doc_id, sum(bare) FILTER (WHERE y > 0.10 * c OR (n >= 4 AND s > 0.25 * n) OR (n <= 40 AND regexp_matches(lower(t), 'BOILERPLATE')) OR (n < 2 AND NOT regexp_matches(t, '[.!?:;…。！？"'')\]]$'))) AS lost FROM m GROUP BY 1),
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(array_to_string(ws, '')) - length(translate(array_to_string(ws, ''), '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars FROM w LEFT JOIN r USING (doc_id) LEFT JOIN f USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_chars <= 0.5 * word_chars AS kept, lost_chars FROM b
""".replace("BOILERPLATE", quality_rules.BOILERPLATE)

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LEAK_SQL = rf"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item, w, least({decontamination.DEPTH}, len(w)) AS k, unnest(range(1, len(w) - least({decontamination.DEPTH}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS x FROM bi), ks AS (SELECT DISTINCT k FROM win),
d AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
dl AS (SELECT doc_id, i, list(x) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {decontamination.DEPTH - 1} FOLLOWING) AS l FROM dw),
h AS (SELECT doc_id, i, k, item FROM (SELECT doc_id, i, k, array_to_string(l[1:k], ' ') AS x FROM dl, ks WHERE len(l) >= k) JOIN win USING (k, x)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM h)) GROUP BY 1),
s AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM h GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
"""

_NEAR_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex({_FOLD}, '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
dw AS (SELECT doc_id, len(w) AS m, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT doc_id, m, list(x) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {ngram_join.WIDTH - 1} FOLLOWING) AS l, i FROM dw),
s AS (SELECT DISTINCT doc_id, array_to_string(l, ' ') AS x FROM g WHERE len(l) = {ngram_join.WIDTH} OR (m < {ngram_join.WIDTH} AND i = 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
k AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {ngram_join.PERCENT} * (x.n + y.n - c)),
e AS (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
r AS (SELECT doc_id, doc_id AS o FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.o)
SELECT r.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(o) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

_W, _P = suffix_dedup.WINDOW, suffix_dedup.PASSAGE_WORDS
_SUFFIX_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
p AS (SELECT doc_id, h, unnest(range(1, n - {_W} + 2)) AS i FROM d WHERE n >= {_W}),
w AS (SELECT doc_id, i, md5_number(substr(h, 2 * i - 1, {2 * _W})) AS x FROM p),
u AS (SELECT doc_id, i FROM w WHERE x IN (SELECT x FROM w GROUP BY x HAVING count(*) > 1)),
f AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {_W} THEN 0 ELSE 1 END AS fresh FROM u),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM f),
s AS (SELECT doc_id, k, min(i) AS a, max(i) + {_W} AS b FROM g GROUP BY 1, 2),
t AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS before, b FROM s),
q AS (SELECT t.doc_id, string_agg(substr(h, 2 * before - 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) - 1) AS kept, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM t JOIN d USING (doc_id) GROUP BY 1),
ws AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
wi AS (SELECT doc_id, w, unnest(range(1, len(w) - {_P} + 2)) AS i FROM ws WHERE len(w) >= {_P}),
wx AS (SELECT doc_id, i, md5_number(array_to_string(w[i:i + {_P - 1}], ' ')) AS x FROM wi),
wp AS (SELECT doc_id, count(DISTINCT j) AS n_passage_words FROM (SELECT doc_id, unnest(range(i, i + {_P})) AS j FROM wx WHERE x IN (SELECT x FROM wx GROUP BY x HAVING count(*) > 1)) GROUP BY 1)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256, coalesce(n_passage_words, 0) AS n_passage_words FROM d LEFT JOIN q USING (doc_id) LEFT JOIN wp USING (doc_id)
"""

_CRC_STEP = "CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END"


def _shard_sql(name: str, n: int) -> str:
    """The shard of the least -ln(u), u drawn by md5."""
    return f"{name} AS (SELECT doc_id, arg_min(i, -ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '#' || CAST(i AS VARCHAR)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)) AS s FROM documents, range({n}) t(i) GROUP BY doc_id)"


_SHARD_SQL = f"""
WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: {_CRC_STEP})) AS crc),
d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, CAST(length(h) // 2 + 1 AS BIGINT) AS size, list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS x FROM d),
c AS (SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295, x), lambda c, y: xor(c >> 8, crc[(xor(c, y) & 255) + 1]))) AS text_crc32 FROM b, t),
{_shard_sql("s", sharding.SHARDS)}, {_shard_sql("g", sharding.SHARDS + 1)},
k AS (SELECT c.*, s.s AS shard, g.s AS grown_shard, CAST('0x' || substr(md5('slot#' || CAST(doc_id AS VARCHAR) || '#' || CAST(size AS VARCHAR) || '#' || CAST(text_crc32 AS VARCHAR)), 1, 6) AS INT) % {sharding.SLOT_BUCKETS} AS bucket FROM c JOIN s USING (doc_id) JOIN g USING (doc_id))
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard, row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, size, text_crc32) - 1 AS slot, CAST(grown_shard AS INT) AS grown_shard FROM k
"""

ORACLE_SQL: dict[str, str] = {
    "op2_suffix_dedup": _SUFFIX_SQL,
    "op7_ngram_join": _NEAR_SQL,
    "op8_decontamination": _LEAK_SQL,
    "op9_sharding": _SHARD_SQL,
    "op5_line_dedup": _LINE_SQL + "SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, md5(CASE WHEN d.text IS NOT NULL THEN g.kept END) AS kept_md5 FROM documents d LEFT JOIN g USING (doc_id)",
    "op6_quality_rules": _QUALITY_SQL,
}
