"""Links between records and graph objects, and entity resolution of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DETECTION_DOMAINS = ("siem_queries", "sigma_rules")
LEAST_NAME = 4
_WORD = r"[A-Za-z0-9_]+"
#: Most words by which texts and terms meet.
PHRASE = 3
#: Terms up to this number are broadcast.
FEW_TERMS = 200_000


def listed(records: DataFrame, column: str, name: str) -> DataFrame:
    """record_id, domain and each id of a comma-joined column."""
    return records.where(F.coalesce(F.col(column), F.lit("")) != "").select(F.col("id").alias("record_id"), "domain", F.explode(F.transform(F.split(column, ","), lambda x: F.trim(x))).alias(name))


def vulnerability_keys(nodes: DataFrame) -> DataFrame:
    return nodes.where("type = 'vulnerability'").select(F.col("name").alias("cve"), "stix_id")


def technique_keys(nodes: DataFrame) -> DataFrame:
    """The technique id of each attack pattern; of several nodes the last by id holds it."""
    return nodes.where("type = 'attack-pattern' AND attack_id IS NOT NULL").groupBy(F.col("attack_id").alias("tech")).agg(F.max("stix_id").alias("stix_id"))


def actor_names(nodes: DataFrame, type_: str = "intrusion-set") -> DataFrame:
    """Names and aliases of LEAST_NAME characters or more: stix_id, term."""
    n = nodes.where(F.col("type") == type_)
    terms = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return n.select("stix_id", F.explode(terms).alias("term")).where(F.length("term") >= LEAST_NAME).distinct()


def _pattern(term: Column) -> Column:
    return F.concat(F.lit("(?i)\\b\\Q"), term, F.lit("\\E\\b"))


def _words(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(f"({_WORD})"), F.lit(1)), F.lower)


def _phrases(words: Column, n: int) -> Column:
    """Each n words that follow one another."""
    if n == 1:
        return words
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(words, i, n)))).otherwise(F.array().cast("array<string>"))


def mentions(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """record_id and stix_id where a term stands in the text as a word, case aside.

    Instead of testing every pair, texts and terms meet on words: the words of a
    term stand in a text that holds it as whole words one after another, whatever is
    at the term's edges, so a term is found by its first words, PHRASE at most, and
    terms that share their first word do not meet every text with it; the exact
    pattern then decides.  Terms without a word, FEW_TERMS at most, are tested
    against all texts.
    """
    first = F.slice(_words(F.col("term")), 1, PHRASE)
    all_keyed = terms.select("stix_id", "term", F.concat_ws(" ", first).alias("word"), F.size(first).alias("n"))
    sizes = {r["n"]: r["count"] for r in all_keyed.groupBy("n").count().collect()}
    wordless = sizes.pop(0, 0)
    if wordless > FEW_TERMS:
        raise ValueError(f"{wordless} terms hold no word")
    lengths = sorted(sizes) or [1]
    each = texts.select("record_id", _words(F.col("text")).alias("words"))
    words = each.select("record_id", F.explode(F.array_distinct(F.flatten(F.array(*(_phrases(F.col("words"), n) for n in lengths))))).alias("word"))
    keyed, odd = all_keyed.where("n > 0").drop("n"), all_keyed.where("n = 0").select("stix_id", "term")
    # few terms go to the texts, so the phrases of all texts need not be shuffled
    candidates = words.join(F.broadcast(keyed) if sum(sizes.values()) <= FEW_TERMS else keyed, "word").select("record_id", "stix_id", "term").distinct()
    found = candidates.join(texts, "record_id").where(F.rlike(F.col("text"), _pattern(F.col("term"))))
    if not wordless:
        return found.select("record_id", "stix_id").distinct()
    other = texts.join(F.broadcast(odd), F.rlike(F.col("text"), _pattern(F.col("term"))))
    return found.select("record_id", "stix_id").unionByName(other.select("record_id", "stix_id")).distinct()


def link(records: DataFrame, nodes: DataFrame) -> DataFrame:
    """stix_id, record_id, link_type, confidence, strategy: five strategies in order, the first to make a pair wins.

    1 CVE ids, 2 technique ids outside detection and log domains, 3 actor names in
    actor texts, 4 technique ids of detection domains, 5 those of logs.
    """
    tech, techs = technique_keys(nodes), listed(records, "mitre_techniques", "tech")
    tagged = lambda df, no, kind, confidence: df.select("stix_id", "record_id", F.lit(kind).alias("link_type"), F.lit(confidence).alias("confidence"), F.lit(no).alias("strategy"))
    by_tech = lambda cond: techs.where(cond).join(tech, "tech")
    actor_texts = records.where("domain = 'apt_intel'").select(F.col("id").alias("record_id"), F.concat(F.coalesce("user_message", F.lit("")), F.lit(" "), F.coalesce("assistant_message", F.lit(""))).alias("text"))
    parts = [
        tagged(listed(records, "cve_ids", "cve").join(vulnerability_keys(nodes), "cve"), 1, "about", 1.0),
        tagged(by_tech(~F.col("domain").isin(*DETECTION_DOMAINS, "log_analysis")), 2, "about", 1.0),
        tagged(mentions(actor_texts, actor_names(nodes)), 3, "about", 0.8),
        tagged(by_tech(F.col("domain").isin(*DETECTION_DOMAINS)), 4, "detects", 1.0),
        tagged(by_tech(F.col("domain") == "log_analysis"), 5, "analyzes", 1.0),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return first_links(out)


def first_links(links: DataFrame) -> DataFrame:
    """One row for each object and record: that of the first strategy."""
    row = F.struct("strategy", "link_type", "confidence")
    return links.groupBy("stix_id", "record_id").agg(F.min(row).alias("r")).select("stix_id", "record_id", "r.link_type", "r.confidence", "r.strategy")


def vulnerability_nodes(records: DataFrame) -> DataFrame:
    """One node for each CVE id, described by the best scored record that names it (never scored last, then by id)."""
    from orefold.functions.ids import uuid5

    each = listed(records, "cve_ids", "name").where(F.col("name").rlike(r"^CVE-\d{4}-\d+")).join(records.select(F.col("id").alias("record_id"), "severity", "cvss_score", "assistant_message", "quality_score"), "record_id")
    w = Window.partitionBy("name").orderBy(F.desc_nulls_last("quality_score"), "record_id")
    best = each.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    return best.select(F.concat(F.lit("vulnerability--"), uuid5(F.col("name"))).alias("stix_id"), F.lit("vulnerability").alias("type"), "name", F.substring("assistant_message", 1, 500).alias("description"), "severity", "cvss_score")


def resolve(names: DataFrame, index: DataFrame) -> DataFrame:
    """names (actor, name, synonyms) with the stix_id of the name or of the first synonym that index (key, stix_id) holds, null if none."""
    terms = F.concat(F.array("name"), F.coalesce("synonyms", F.array().cast("array<string>")))
    each = names.select("actor", F.posexplode(terms).alias("pos", "term")).withColumn("key", F.lower("term"))
    hit = each.join(index, "key").groupBy("actor").agg(F.min_by("stix_id", "pos").alias("stix_id"))
    return names.join(hit, "actor", "left")


def merge_aliases(own: Column, more: Column) -> Column:
    """own and those of more that own does not hold, case aside."""
    own = F.coalesce(own, F.array().cast("array<string>"))
    low = F.transform(own, F.lower)
    return F.concat(own, F.filter(more, lambda x: ~F.array_contains(low, F.lower(x))))


def distinct_aliases(name: Column, aliases: Column) -> Column:
    """aliases without repeats and without the name, case aside, in order."""
    low = F.transform(aliases, F.lower)
    return F.filter(aliases, lambda x, i: (F.lower(x) != F.lower(name)) & (F.array_position(low, F.lower(x)) == i + 1))
