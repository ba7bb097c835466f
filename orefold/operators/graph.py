"""A typed property graph over node and edge DataFrames.

nodes: stix_id, type, name, aliases, description, external_ids (map of string lists), kill_chain_phases.
edges: src, dst, rel_type, description.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: kill-chain phases in order.
KILL_CHAIN = ("reconnaissance", "resource-development", "initial-access", "execution", "persistence", "privilege-escalation", "defense-evasion", "credential-access", "discovery", "lateral-movement", "collection", "command-and-control", "exfiltration", "impact")
INDEXED_TYPES = ("intrusion-set", "attack-pattern", "malware", "tool", "campaign", "course-of-action", "x-mitre-data-source", "x-mitre-data-component")


#: Ids that a join may broadcast; more are shuffled.
FEW_IDS = 200_000


def sized(ids: DataFrame, most: int = FEW_IDS) -> DataFrame:
    """ids, to be broadcast if they are counted to be few."""
    return F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids


def phase_order(phase: Column) -> Column:
    """The place of a phase in the chain; 99 for any other."""
    at = F.array_position(F.array(*map(F.lit, KILL_CHAIN)), phase)
    return F.when(F.coalesce(at, F.lit(0)) > 0, at - 1).otherwise(99)


def ordered_phases(phases: Column) -> Column:
    return F.filter(F.array(*map(F.lit, KILL_CHAIN)), lambda p: F.array_contains(phases, p))


def primary_phase(phases: Column) -> Column:
    """The first phase in chain order, else the first listed, else unknown."""
    return F.coalesce(F.get(ordered_phases(phases), F.lit(0)), F.get(phases, F.lit(0)), F.lit("unknown"))


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame

    def of_type(self, *types: str) -> DataFrame:
        return self.nodes.where(F.col("type").isin(*types))

    def name_index(self) -> DataFrame:
        """key and stix_id: names, aliases and single external ids in lower case; of several nodes the last by id holds a key."""
        n = self.of_type(*INDEXED_TYPES)
        keys = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
        if "external_ids" in n.columns:
            single = F.transform(F.filter(F.map_values("external_ids"), lambda v: F.size(v) == 1), lambda v: v[0])
            keys = F.concat(keys, F.coalesce(single, F.array().cast("array<string>")))
        each = n.select("stix_id", F.explode(keys).alias("k")).where("k IS NOT NULL")
        return each.groupBy(F.lower("k").alias("key")).agg(F.max("stix_id").alias("stix_id"))

    def by_name(self, name: str) -> DataFrame:
        """The node of an indexed name; else any node of that name."""
        hit = self.name_index().where(F.col("key") == name.lower())
        other = self.nodes.where(F.lower("name") == name.lower()).join(hit.limit(1).select(F.lit(1).alias("x")), F.lit(True), "left_anti")
        return self.nodes.join(F.broadcast(hit.select("stix_id")), "stix_id", "left_semi").unionByName(other)

    def relationships(self, direction: str = "both", rel_type: str | None = None) -> DataFrame:
        """All relationships seen from each node: stix_id, direction, relationship_type, related_id, related_name, related_type; '' for missing nodes."""
        e = self.edges if rel_type is None else self.edges.where(F.col("rel_type") == rel_type)
        parts = []
        if direction in ("outgoing", "both"):
            parts.append(e.select(F.col("src").alias("stix_id"), F.lit("outgoing").alias("direction"), F.col("rel_type").alias("relationship_type"), F.col("dst").alias("related_id")))
        if direction in ("incoming", "both"):
            parts.append(e.select(F.col("dst").alias("stix_id"), F.lit("incoming").alias("direction"), F.col("rel_type").alias("relationship_type"), F.col("src").alias("related_id")))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        other = self.nodes.select(F.col("stix_id").alias("related_id"), F.col("name").alias("related_name"), F.col("type").alias("related_type"))
        return rows.join(other, "related_id", "left").fillna("", ["related_name", "related_type"])

    def neighbours(self, rel_type: str | None = None, type_: str | tuple[str, ...] | None = None, incoming: bool = False, source_type: str | None = None) -> DataFrame:
        """stix_id and its neighbours (other_id, other_name, other_type); edges that repeat give repeated rows, missing nodes none."""
        near, far = ("dst", "src") if incoming else ("src", "dst")
        e = self.edges if rel_type is None else self.edges.where(F.col("rel_type") == rel_type)
        other = self.nodes
        if type_:
            other = other.where(F.col("type").isin(*((type_,) if isinstance(type_, str) else type_)))
        other = other.select(F.col("stix_id").alias("other_id"), F.col("name").alias("other_name"), F.col("type").alias("other_type"))
        out = e.select(F.col(near).alias("stix_id"), F.col(far).alias("other_id")).join(other, "other_id")
        if source_type:
            out = out.join(self.of_type(source_type).select("stix_id"), "stix_id", "left_semi")
        return out.select("stix_id", "other_id", "other_name", "other_type")

    def actor_techniques(self) -> DataFrame:
        return self.neighbours("uses", "attack-pattern", source_type="intrusion-set")

    def actor_software(self) -> DataFrame:
        return self.neighbours("uses", ("malware", "tool"), source_type="intrusion-set")

    def actor_campaigns(self) -> DataFrame:
        return self.neighbours("attributed-to", "campaign", incoming=True, source_type="intrusion-set")

    def technique_actors(self) -> DataFrame:
        return self.neighbours("uses", "intrusion-set", incoming=True, source_type="attack-pattern")

    def technique_mitigations(self) -> DataFrame:
        return self.neighbours("mitigates", "course-of-action", incoming=True, source_type="attack-pattern")

    def technique_software(self) -> DataFrame:
        return self.neighbours("uses", ("malware", "tool"), incoming=True, source_type="attack-pattern")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "Graph":
        """The nodes and edges stored below a folder."""
        return cls(spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/edges"))

    def path(self, starts: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
        """start and stix_id of all nodes reached from starts (stix_id) over typed outgoing steps, each once."""
        at = starts.select(F.col("stix_id").alias("start"), "stix_id").distinct()
        for rel_type, type_ in steps:
            hop = self.neighbours(rel_type, type_).select("stix_id", "other_id")
            at = at.join(hop, "stix_id").select("start", F.col("other_id").alias("stix_id")).distinct()
        return at

    def stored(self, folder: str) -> "Graph":
        """The graph written below a folder and loaded again, for several passes over it."""
        spark = self.nodes.sparkSession
        self.nodes.write.parquet(f"{folder}/nodes")
        self.edges.write.parquet(f"{folder}/edges")
        return type(self).load(spark, folder)

    def reach(self, start: str, depth: int) -> DataFrame:
        """stix_id and depth of the nodes within depth undirected hops, depth the least over all paths; vulnerabilities are not entered.

        Each hop reads the edges that touch the frontier, from either end, and drops what was seen.
        """
        closed = self.of_type("vulnerability").select("stix_id")
        seen = self.nodes.where(F.col("stix_id") == start).select("stix_id", F.lit(0).alias("depth"))
        frontier = seen
        for d in range(1, depth + 1):
            at = sized(frontier.select("stix_id"))
            ends = [self.edges.join(at, F.col(own) == F.col("stix_id"), "left_semi").select(F.col(other).alias("stix_id")) for own, other in (("src", "dst"), ("dst", "src"))]
            step = ends[0].unionByName(ends[1]).distinct().join(closed, "stix_id", "left_anti")
            frontier = step.join(seen, "stix_id", "left_anti").withColumn("depth", F.lit(d)).persist()
            seen = seen.unionByName(frontier)
        return seen.join(self.nodes.select("stix_id"), "stix_id", "left_semi")

    def subgraph(self, start: str, depth: int = 2, parity: bool = False) -> tuple[DataFrame, DataFrame]:
        """Nodes with depth, and the edges met on the way; with parity an edge counts once for each of its ends that was expanded."""
        near = self.reach(start, depth).persist()
        expanded = sized(near.where(F.col("depth") < depth).select("stix_id"))
        closed = self.of_type("vulnerability").select("stix_id")
        ends = []
        for own, other in (("src", "dst"), ("dst", "src")):
            e = self.edges.join(expanded, F.col(own) == F.col("stix_id"), "left_semi").join(closed, F.col(other) == F.col("stix_id"), "left_anti")
            ends.append(e.select("src", "dst", "rel_type"))
        edges = ends[0].unionByName(ends[1])
        if not parity:
            edges = edges.distinct()
        nodes = near.join(self.nodes, "stix_id")
        if "description" in nodes.columns:
            nodes = nodes.withColumns({"description": F.substring("description", 1, 300), "aliases": F.slice("aliases", 1, 5)})
        return nodes, edges

    @staticmethod
    def degrees(edges: DataFrame) -> DataFrame:
        return edges.select(F.explode(F.array("src", "dst")).alias("stix_id")).groupBy("stix_id").agg(F.count(F.lit(1)).alias("degree"))

    def pruned_subgraph(self, start: str, depth: int = 2, most: int = 200, parity: bool = False) -> tuple[DataFrame, DataFrame]:
        """The start and the closest, then best connected nodes, at most most in all; edges between them; degrees counted anew."""
        nodes, edges = self.subgraph(start, depth, parity)
        edges = edges.persist()
        ranked = nodes.join(self.degrees(edges), "stix_id", "left").fillna(0, ["degree"])
        order = [(F.col("stix_id") == start).desc(), F.col("depth"), F.col("degree").desc(), F.col("stix_id")]
        kept = ranked.orderBy(*order).limit(most).drop("degree").persist()
        ids = kept.select("stix_id")
        inner = edges.join(F.broadcast(ids), F.col("src") == F.col("stix_id"), "left_semi").join(F.broadcast(ids), F.col("dst") == F.col("stix_id"), "left_semi")
        return kept.join(self.degrees(inner), "stix_id", "left").fillna(0, ["degree"]), inner

    def search(self, query: str, limit: int = 20) -> DataFrame:
        """stix_id, type, name and score of the best matches: exact names 100, beginnings 80 and other places 50 plus up to 30 for short keys, CVE names 60."""
        q = query.lower()
        index = self.name_index().where(F.col("key").contains(q))
        score = F.when(F.col("key") == q, 100).otherwise(F.when(F.col("key").startswith(q), 80).otherwise(50) + F.greatest(F.lit(0), 30 - F.length("key")))
        best = index.withColumn("score", score).groupBy("stix_id").agg(F.max(F.when(F.col("key") == q, 1).otherwise(0)).alias("exact"), F.max("score").alias("score"))
        found = best.select("stix_id", F.when(F.col("exact") == 1, 100).otherwise(F.col("score")).alias("score"))
        if q.startswith("cve-"):
            found = found.unionByName(self.of_type("vulnerability").where(F.lower("name").contains(q)).select("stix_id", F.lit(60).alias("score")))
        return found.join(self.nodes.select("stix_id", "type", "name"), "stix_id").orderBy(F.desc("score"), "stix_id").limit(limit).select("stix_id", "type", "name", "score")

    def stats(self, links: DataFrame | None = None) -> DataFrame:
        """kind, name, n: nodes by type, edges by type, and links by type if given."""
        parts = [self.nodes.groupBy(F.col("type").alias("name")).count().withColumn("kind", F.lit("object")), self.edges.groupBy(F.col("rel_type").alias("name")).count().withColumn("kind", F.lit("relationship"))]
        if links is not None:
            parts.append(links.groupBy(F.col("link_type").alias("name")).count().withColumn("kind", F.lit("link")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.select("kind", "name", F.col("count").alias("n"))

    def merged_stats(self, links: DataFrame) -> DataFrame:
        """name with object, relationship and training counts; node and edge types share the names."""
        typed = links.join(self.nodes.select("stix_id", "type"), "stix_id").groupBy(F.col("type").alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("link").alias("kind"), "name", "n")
        wide = self.stats().unionByName(typed).groupBy("name").pivot("kind", ["object", "relationship", "link"]).sum("n")
        return wide.select("name", *(F.coalesce(F.col(k), F.lit(0)).alias(f"{k}_count") for k in ("object", "relationship", "link")))

    def campaigns(self) -> DataFrame:
        """Campaigns by name with counts of techniques, malware and tools, their phases in order, and their first actor."""
        used = self.neighbours("uses", ("attack-pattern", "malware", "tool"), source_type="campaign")
        phases = self.nodes.select(F.col("stix_id").alias("other_id"), "kill_chain_phases")
        sums = used.join(phases, "other_id", "left").groupBy("stix_id").agg(
            F.count_if(F.col("other_type") == "attack-pattern").alias("technique_count"),
            F.count_if(F.col("other_type") == "malware").alias("malware_count"),
            F.count_if(F.col("other_type") == "tool").alias("tool_count"),
            F.array_distinct(F.flatten(F.collect_list(F.when(F.col("other_type") == "attack-pattern", F.col("kill_chain_phases"))))).alias("__p"),
        )
        actors = self.neighbours("attributed-to", "intrusion-set", source_type="campaign").groupBy("stix_id").agg(F.min_by("other_name", "other_id").alias("actor"))
        counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("technique_count", "malware_count", "tool_count")}
        return self.of_type("campaign").select("stix_id", "name").join(sums, "stix_id", "left").join(actors, "stix_id", "left").withColumns(counts).withColumn("phases", ordered_phases(F.coalesce("__p", F.array().cast("array<string>")))).drop("__p").orderBy("name", "stix_id")

    def campaign_techniques(self) -> DataFrame:
        """The techniques of each campaign in kill-chain order, then by id: stix_id, other_id, other_name, phase, position."""
        used = self.neighbours("uses", "attack-pattern", source_type="campaign")
        rows = used.join(self.nodes.select(F.col("stix_id").alias("other_id"), "kill_chain_phases"), "other_id").withColumn("phase", primary_phase(F.col("kill_chain_phases")))
        w = Window.partitionBy("stix_id").orderBy(phase_order(F.col("phase")), "other_id")
        return rows.withColumn("position", F.row_number().over(w)).select("stix_id", "other_id", "other_name", "phase", "position")

    def shared_actors(self) -> DataFrame:
        """Pairs of techniques (a < b) and how many actors use both."""
        use = self.actor_techniques().select(F.col("stix_id").alias("actor"), F.col("other_id").alias("tech")).distinct()
        return use.alias("x").join(use.alias("y"), (F.col("x.actor") == F.col("y.actor")) & (F.col("x.tech") < F.col("y.tech"))).groupBy(F.col("x.tech").alias("a"), F.col("y.tech").alias("b")).agg(F.count(F.lit(1)).alias("n_actors"))

    def actors_of_all(self, wanted: DataFrame) -> DataFrame:
        """group and actor where the actor uses every technique of the group; wanted: group, tech (relational division)."""
        need = wanted.select("group", "tech").distinct()
        size = need.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
        use = self.actor_techniques().select(F.col("stix_id").alias("actor"), F.col("other_id").alias("tech")).distinct()
        have = need.join(use, "tech").groupBy("group", "actor").agg(F.count(F.lit(1)).alias("m"))
        return have.join(size, "group").where("m = n").select("group", "actor")

    def mitigation_coverage(self, most: int = 10) -> DataFrame:
        """For each actor the mitigations that cover most of its techniques, the best most."""
        use = self.actor_techniques().select(F.col("stix_id").alias("actor"), F.col("other_id").alias("tech")).distinct()
        help_ = self.technique_mitigations().select(F.col("stix_id").alias("tech"), F.col("other_id").alias("mitigation")).distinct()
        counted = use.join(help_, "tech").groupBy("actor", "mitigation").agg(F.count_distinct("tech").alias("covered"))
        w = Window.partitionBy("actor").orderBy(F.desc("covered"), "mitigation")
        return counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)

    def detection_coverage(self, detected: DataFrame) -> DataFrame:
        """For each actor its techniques, how many detected (stix_id) holds, the whole percentage and a tier."""
        use = self.actor_techniques().select(F.col("stix_id").alias("actor"), F.col("other_id").alias("tech")).distinct()
        hit = detected.select(F.col("stix_id").alias("tech"), F.lit(1).alias("hit")).distinct()
        out = use.join(hit, "tech", "left").groupBy("actor").agg(F.count(F.lit(1)).alias("total"), F.count("hit").alias("covered"))
        pct = F.floor(100 * F.col("covered") / F.col("total"))
        return out.withColumn("pct", pct).withColumn("tier", F.when(pct < 50, "LOW").when(pct < 80, "MODERATE").otherwise("HIGH"))

    def subtechniques(self, least: int = 2) -> DataFrame:
        """Parents with at least least children, the children's names sorted."""
        kids = self.neighbours("subtechnique-of", "attack-pattern").select(F.col("other_id").alias("parent"), "stix_id").distinct()
        names = kids.join(self.nodes.select("stix_id", "name"), "stix_id")
        return names.groupBy("parent").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("name")).alias("children")).where(F.col("n") >= least)

    def tactic_counts(self, most: int = 5) -> DataFrame:
        """For each actor its most used tactics; a technique counts for each of its phases."""
        use = self.actor_techniques().join(self.nodes.select(F.col("stix_id").alias("other_id"), "kill_chain_phases"), "other_id")
        counted = use.select(F.col("stix_id").alias("actor"), F.explode("kill_chain_phases").alias("tactic")).groupBy("actor", "tactic").agg(F.count(F.lit(1)).alias("n"))
        return counted.withColumn("rank", F.row_number().over(Window.partitionBy("actor").orderBy(F.desc("n"), "tactic"))).where(F.col("rank") <= most)


def with_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose ends both exist."""
    ids = nodes.select("stix_id")
    return edges.join(ids, F.col("src") == F.col("stix_id"), "left_semi").join(ids, F.col("dst") == F.col("stix_id"), "left_semi")


def insert_edges(stored: DataFrame | None, new: DataFrame, nodes: DataFrame, order: str = "seq") -> DataFrame:
    """New edges that have both ends and whose relationship_id is neither stored nor held by an earlier one."""
    sound = with_ends(new, nodes)
    first = sound.groupBy("relationship_id").agg(F.min_by(F.struct(*sound.columns), F.col(order)).alias("r")).select("r.*")
    return first if stored is None else first.join(stored.select("relationship_id"), "relationship_id", "left_anti")


def inverted_index(rows: DataFrame, key: str, value: str, least: int = 1, most: int | None = None) -> DataFrame:
    """key, n distinct values, and few: the first of them in order; keys with fewer than least values are left out."""
    once = rows.select(F.col(key).alias("key"), F.col(value).alias("value")).where("key IS NOT NULL AND value IS NOT NULL").distinct()
    w = Window.partitionBy("key").orderBy("value")
    ranked = once.select("key", "value", F.row_number().over(w).alias("rank"))
    kept = F.when(F.col("rank") <= most, F.col("value")) if most else F.col("value")
    out = ranked.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(kept)).alias("few"))
    return out.where(F.col("n") >= least)
