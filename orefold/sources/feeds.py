"""Threat-intelligence feeds landed as files: STIX bundles, actor galaxies, exploited and published vulnerabilities, rules, action logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orefold.functions import text as tx

#: Object types of the graph.
NODE_TYPES = ("attack-pattern", "intrusion-set", "malware", "tool", "campaign", "course-of-action", "x-mitre-data-source", "x-mitre-data-component", "x-mitre-tactic", "x-mitre-matrix")
_REFS = "array<struct<source_name:string,external_id:string>>"
BUNDLE = f"objects array<struct<type:string,id:string,name:string,description:string,aliases:array<string>,x_mitre_aliases:array<string>,external_references:{_REFS},kill_chain_phases:array<struct<kill_chain_name:string,phase_name:string>>,x_mitre_platforms:array<string>,revoked:boolean,x_mitre_deprecated:boolean,source_ref:string,target_ref:string,relationship_type:string>>"
GALAXY = "values array<struct<value:string,uuid:string,description:string,meta:struct<synonyms:array<string>,country:string,`cfr-suspected-state-sponsor`:string,`cfr-suspected-victims`:array<string>,`cfr-target-category`:array<string>,motive:string,`cfr-type-of-incident`:string>>>"
KEV = "vulnerabilities array<struct<cveID:string,product:string,vendorProject:string,vulnerabilityName:string,shortDescription:string,requiredAction:string,dueDate:string,dateAdded:string,knownRansomwareCampaignUse:string,notes:string>>"
_METRIC = "struct<baseScore:double,baseSeverity:string,vectorString:string>"
_CONTAINER = f"descriptions:array<struct<lang:string,value:string>>,metrics:array<struct<cvssV3_1:{_METRIC},cvssV4_0:{_METRIC},cvssV3_0:{_METRIC}>>,problemTypes:array<struct<descriptions:array<struct<cweId:string,description:string>>>>,affected:array<struct<vendor:string,product:string,versions:array<struct<status:string,version:string,versionType:string,lessThan:string,lessThanOrEqual:string>>>>,solutions:array<struct<value:string>>,workarounds:array<struct<value:string>>,references:array<struct<url:string,tags:array<string>>>"
CVE = f"cveMetadata struct<state:string,cveId:string,datePublished:string>, containers struct<cna:struct<{_CONTAINER}>,adp:array<struct<{_CONTAINER}>>>"


def fresh(df: DataFrame, days: int = 7) -> DataFrame:
    """Rows of files modified within so many days; df must carry _metadata."""
    return df.where(F.col("_metadata.file_modification_time") >= F.current_timestamp() - F.expr(f"INTERVAL {int(days)} DAYS"))


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    """The active objects of STIX bundles: neither revoked nor deprecated."""
    o = spark.read.schema(BUNDLE).json(path, multiLine=True).select(F.explode("objects").alias("o")).select("o.*")
    return o.where(~F.coalesce("revoked", F.lit(False)) & ~F.coalesce("x_mitre_deprecated", F.lit(False)))


def attack_id(refs: Column) -> Column:
    return F.get(F.filter(refs, lambda r: r["source_name"] == "mitre-attack"), F.lit(0))["external_id"]


def nodes_of_bundle(objects: DataFrame) -> DataFrame:
    from orefold.operators.linking import distinct_aliases

    refs = F.filter(F.coalesce("external_references", F.array().cast(_REFS)), lambda r: (F.coalesce(r["source_name"], F.lit("")) != "") & (F.coalesce(r["external_id"], F.lit("")) != ""))
    other = F.filter(refs, lambda r: r["source_name"] != "mitre-attack")
    last = F.filter(other, lambda r, i: ~F.exists(F.slice(other, i + 2, F.size(other)), lambda x: x["source_name"] == r["source_name"]))
    own = F.when(F.col("attack_id").isNotNull(), F.array(F.struct(F.lit("mitre_attack_id").alias("source_name"), F.col("attack_id").alias("external_id")))).otherwise(F.array().cast(_REFS))
    none = F.array().cast("array<string>")
    phases = F.transform(F.filter(F.coalesce("kill_chain_phases", F.array().cast("array<struct<kill_chain_name:string,phase_name:string>>")), lambda p: p["kill_chain_name"] == "mitre-attack"), lambda p: p["phase_name"])
    return objects.where(F.col("type").isin(*NODE_TYPES)).withColumn("attack_id", attack_id(F.col("external_references"))).select(
        F.col("id").alias("stix_id"),
        "type",
        F.coalesce("name", F.lit("")).alias("name"),
        distinct_aliases(F.coalesce("name", F.lit("")), F.concat(F.coalesce("aliases", none), F.coalesce("x_mitre_aliases", none))).alias("aliases"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.map_from_entries(F.transform(F.concat(own, last), lambda r: F.struct(r["source_name"], F.array(r["external_id"])))).alias("external_ids"),
        "attack_id",
        F.coalesce("x_mitre_platforms", none).alias("platforms"),
        phases.alias("kill_chain_phases"),
    )


def edges_of_bundle(objects: DataFrame) -> DataFrame:
    return objects.where("type = 'relationship'").select(F.col("id").alias("relationship_id"), F.col("source_ref").alias("src"), F.col("target_ref").alias("dst"), F.col("relationship_type").alias("rel_type"), F.coalesce("description", F.lit("")).alias("description"))


def read_galaxy(spark: SparkSession, path: str) -> DataFrame:
    """Actors with a name: actor (uuid), name, synonyms and their other fields."""
    v = spark.read.schema(GALAXY).json(path, multiLine=True).select(F.explode("values").alias("v"))
    return v.where("coalesce(v.value, '') <> ''").select(F.col("v.uuid").alias("actor"), F.col("v.value").alias("name"), F.col("v.meta.synonyms").alias("synonyms"), F.substring("v.description", 1, 5000).alias("description"), F.col("v.meta.country").alias("country"), F.col("v.meta.cfr-suspected-state-sponsor").alias("sponsor"), F.col("v.meta.cfr-suspected-victims").alias("victims"), F.col("v.meta.cfr-target-category").alias("target_categories"), F.col("v.meta.motive").alias("motive"))


def read_kev(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KEV).json(path, multiLine=True).select(F.explode("vulnerabilities").alias("v")).select("v.*")


def read_cves(spark: SparkSession, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Published vulnerability files CVE-*.json below path, of the years from start to end where given."""
    years = f"{path}/{{{','.join(str(y) for y in range(start, end + 1))}}}" if start and end else path
    reader = spark.read.schema(CVE).option("multiLine", True).option("pathGlobFilter", "CVE-*.json")
    df = reader.json(f"{years}/*") if start and end else reader.option("recursiveFileLookup", True).json(path)
    return df.where("cveMetadata.state = 'PUBLISHED'")


def cvss(c: Column) -> Column:
    """The first metric of: the issuer's 3.1, another provider's 3.1, the issuer's 4.0, the issuer's 3.0."""
    first = lambda metrics, name: F.get(F.filter(F.transform(metrics, lambda m: m[name]), lambda x: x.isNotNull()), F.lit(0))
    others = F.flatten(F.transform(c["adp"], lambda a: F.coalesce(a["metrics"], c["cna"]["metrics"])))
    return F.coalesce(first(c["cna"]["metrics"], "cvssV3_1"), first(others, "cvssV3_1"), first(c["cna"]["metrics"], "cvssV4_0"), first(c["cna"]["metrics"], "cvssV3_0"))


def weaknesses(c: Column) -> Column:
    """CWE ids and texts of the issuer, then of others, each id once."""
    flat = lambda p: F.flatten(F.transform(p, lambda x: x["descriptions"]))
    none = F.array().cast("array<struct<cweId:string,description:string>>")
    found = F.filter(F.concat(F.coalesce(flat(c["cna"]["problemTypes"]), none), F.coalesce(F.flatten(F.transform(c["adp"], lambda a: F.coalesce(flat(a["problemTypes"]), none))), none)), lambda x: x["cweId"].isNotNull())
    once = F.filter(found, lambda x, i: F.array_position(F.transform(found, lambda y: y["cweId"]), x["cweId"]) == i + 1)
    return F.transform(once, lambda x: F.struct(x["cweId"].alias("id"), tx.strip_cwe_prefix(F.coalesce(x["description"], F.lit(""))).alias("text")))


def products(c: Column) -> Column:
    """Affected products without placeholder names and commit ranges: vendor, product, ranges, fixes."""
    known = F.filter(c["cna"]["affected"], lambda a: (F.lower(F.coalesce(a["product"], F.lit("n/a"))) != "n/a") & (F.lower(F.coalesce(a["vendor"], F.lit("n/a"))) != "n/a"))
    none = F.array().cast("array<struct<status:string,version:string,versionType:string,lessThan:string,lessThanOrEqual:string>>")

    def one(a: Column) -> Column:
        bad = F.filter(F.coalesce(a["versions"], none), lambda v: (v["status"] == "affected") & (F.coalesce(v["versionType"], F.lit("")) != "git"))
        span = F.transform(bad, lambda v: F.when(v["lessThan"].isNotNull(), F.concat(v["version"], F.lit(" to < "), v["lessThan"])).when(v["lessThanOrEqual"].isNotNull(), F.concat(v["version"], F.lit(" to "), v["lessThanOrEqual"])).otherwise(v["version"]))
        fixes = F.filter(F.transform(bad, lambda v: v["lessThan"]), lambda x: x.isNotNull() & ~x.contains("*"))
        return F.struct(a["vendor"].alias("vendor"), a["product"].alias("product"), span.alias("ranges"), F.array_distinct(fixes).alias("fixes"))

    return F.transform(known, one)


def solution(c: Column) -> Column:
    """The first solution with text, else the first workaround, without markup."""
    first = lambda xs: F.get(F.filter(F.transform(xs, lambda x: tx.strip_html(F.coalesce(x["value"], F.lit("")))), lambda x: x != ""), F.lit(0))
    return F.coalesce(first(c["cna"]["solutions"]), first(c["cna"]["workarounds"]))


PATCH_TAGS = ("patch", "vendor-advisory", "mitigation")


def patch_urls(c: Column) -> Column:
    return F.transform(F.filter(c["cna"]["references"], lambda r: F.arrays_overlap(r["tags"], F.array(*map(F.lit, PATCH_TAGS)))), lambda r: r["url"])


def brief_products(found: Column, most: int = 3) -> Column:
    """The first products by name, and how many more there are."""
    names = F.transform(found, lambda p: F.concat(p["vendor"], F.lit(" "), p["product"]))
    return F.concat(F.array_join(F.slice(names, 1, most), ", "), F.when(F.size(names) > most, F.format_string(" and %d more", F.size(names) - most)).otherwise(""))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Detection rules with their techniques, status, level and score: file, text, technique_ids, status, level, score."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.yml").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    t = F.col("text")
    status, level = tx.rule_field(t, "status", "experimental"), tx.rule_field(t, "level", "medium")
    return df.withColumns({"technique_ids": tx.rule_techniques(t), "status": status, "level": level, "score": tx.rule_score(status, level)}).where(F.size("technique_ids") > 0)


def best_rules(rules: DataFrame) -> DataFrame:
    """The rule of the least score for each technique, ties by file."""
    return rules.select(F.explode("technique_ids").alias("technique_id"), "file", "text", "score").groupBy("technique_id").agg(F.min_by(F.struct("file", "text", "score"), F.struct("score", "file")).alias("r")).select("technique_id", "r.*")


ACTIONS_CSV = "episode INT, frame_index INT, frame_path STRING, action STRING, timestamp DOUBLE"


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """Action logs; of several rows of one frame the last in time order stays."""
    df = spark.read.schema(ACTIONS_CSV).csv(path, header=True)
    w = Window.partitionBy("episode", "frame_index").orderBy(F.desc("timestamp"), F.desc("action"))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def frames_of_episodes(episodes: DataFrame, observations: str, actions: str, rewards: str, key: str) -> DataFrame:
    """Parallel arrays of an episode as frames in order."""
    zipped = F.arrays_zip(F.col(observations).alias("frame_path"), F.col(actions).alias("action_id"), F.col(rewards).alias("reward"))
    return episodes.select(F.col(key).alias("episode_id"), F.posexplode(zipped).alias("frame_index", "f")).select("episode_id", "frame_index", "f.*")


def queries_of_analysis(df: DataFrame) -> DataFrame:
    """Suggested searches of analysis rows: JSON lists, or objects with a list of searches; bad JSON gives none."""
    item = "array<struct<title:string,query:string,description:string>>"
    both = F.array("suggested_searches", "tstats_searches")
    each = df.select("filename", F.posexplode(both).alias("kind", "j")).withColumn("v", F.try_parse_json("j"))
    listed = F.coalesce(F.try_variant_get("v", "$.searches", "variant").cast("string"), F.col("v").cast("string"))
    return each.select("filename", F.when(F.col("kind") == 0, "search").otherwise("tstats").alias("kind"), F.explode(F.from_json(listed, item)).alias("s")).select("filename", "kind", "s.*").where(F.length(F.trim("query")) >= 50)


def with_frame_files(frames: DataFrame, files: DataFrame) -> DataFrame:
    """frames with file: the PNG of their frame_path, else the PPM, else null."""
    kind = F.regexp_extract("file", r"\.(png|ppm)$", 1)
    there = files.select(F.regexp_replace("file", r"\.(png|ppm)$", "").alias("frame_path"), "file", kind.alias("__kind")).where("__kind <> ''")
    best = there.groupBy("frame_path").agg(F.min_by("file", "__kind").alias("file"))  # png sorts before ppm
    return frames.join(best, "frame_path", "left")


def without_truth(event: Column, keys: tuple[str, ...]) -> Column:
    """A map of event fields without the keys that give the answer away."""
    return F.map_filter(event, lambda k, v: ~k.isin(*keys))


def shown_fields(event: Column, keys: tuple[str, ...]) -> Column:
    """The listed fields that hold something, as JSON."""
    return F.to_json(F.map_filter(event, lambda k, v: k.isin(*keys) & (F.coalesce(v, F.lit("")) != "")))
