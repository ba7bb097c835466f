"""Graph-to-text and feed-to-text reports: each turns DataFrames into question and answer pairs.

Lists inside answers are sorted and cut; answers end at MAX_ANSWER characters.
Questions are chosen from templates by the hash of what they ask about.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.functions import ids
from orefold.functions import text as tx
from orefold.operators.graph import Graph, ordered_phases, phase_order
from orefold.operators.records import dedup_new, with_metadata
from orefold.sources import feeds

MAX_ANSWER = 2000


def names(column: str, most: int) -> Column:
    """The first distinct names in order, comma-joined."""
    return F.array_join(F.slice(F.array_sort(F.collect_set(column)), 1, most), ", ")


def lines(*parts: Column) -> Column:
    """Parts that hold something, as lines; cut at MAX_ANSWER."""
    return F.substring(F.concat_ws("\n", *(F.when(p != "", p) for p in parts)), 1, MAX_ANSWER)


def item(title: str, value: Column) -> Column:
    return F.when(value != "", F.concat(F.lit(f"{title}: "), value))


def question(key: Column, subject: Column, templates: list[str]) -> Column:
    """A template with {x} replaced by the subject."""
    return F.replace(ids.template(key, templates), F.lit("{x}"), subject)


def _pairs(df: DataFrame, q: Column, a: Column) -> DataFrame:
    return df.select(q.alias("user_message"), a.alias("assistant_message"))


def few_names(df: DataFrame, keys: list[str], column: str, most: int, name: str) -> DataFrame:
    """keys and the first distinct names of each, comma-joined; no more than these are ever gathered."""
    w = Window.partitionBy(*keys).orderBy(column)
    first = df.select(*keys, column).where(F.col(column).isNotNull()).distinct().withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most)
    return first.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(column)), ", ").alias(name))


def _near(g: Graph, df: DataFrame, column: str, most: int = 8) -> DataFrame:
    """stix_id with how many neighbours there are and their first names."""
    n = df.groupBy("stix_id").agg(F.count(F.lit(1)).alias(f"n_{column}"))
    return n.join(few_names(df, ["stix_id"], "other_name", most, column), "stix_id", "left").fillna("", [column])


def actor_techniques(g: Graph) -> DataFrame:
    """Per actor all techniques by tactic, and per tactic of two or more its list."""
    used = g.actor_techniques().join(g.nodes.select(F.col("stix_id").alias("other_id"), "kill_chain_phases"), "other_id").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("stix_id")))
    by = used.select("stix_id", "n", "other_name", F.explode("kill_chain_phases").alias("tactic")).groupBy("stix_id", "tactic").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("m"), names("other_name", 6).alias("few"), names("other_name", 1000).alias("all"))
    actors = g.of_type("intrusion-set").select("stix_id", "name", "aliases")
    each = by.join(actors, "stix_id")
    broad = each.groupBy("stix_id", "name", "aliases", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tactic", "few"))), lambda x: F.concat(tx.label(x["tactic"]), F.lit(": "), x["few"])), "\n").alias("body")).where("n >= 2")
    one = _pairs(broad, question(F.col("name"), F.col("name"), ["What techniques does {x} use?", "Describe the techniques of {x}."]), lines(F.format_string("%s uses %d techniques.", "name", "n"), item("Also known as", F.array_join(F.slice("aliases", 1, 5), ", ")), F.col("body")))
    two = each.where("m >= 2")
    return one.unionByName(_pairs(two, F.concat(F.lit("Which "), F.lower(tx.label(F.col("tactic"))), F.lit(" techniques does "), "name", F.lit(" use?")), lines(F.concat("name", F.lit(" uses:")), F.col("all"))))


def actor_arsenal(g: Graph) -> DataFrame:
    """Malware and tools of each actor."""
    soft = _near(g, g.actor_software(), "software", 15).join(g.of_type("intrusion-set").select("stix_id", "name"), "stix_id")
    return _pairs(soft, question(F.col("name"), F.col("name"), ["What malware and tools does {x} use?", "Describe the software arsenal of {x}."]), lines(F.format_string("%s uses %d programs.", "name", "n_software"), item("Software", F.col("software"))))


def attribution(g: Graph) -> DataFrame:
    """Who uses a technique or program, who stands behind a campaign."""
    kinds = ("attack-pattern", "malware", "tool")
    users = _near(g, g.neighbours("uses", "intrusion-set", incoming=True), "who", 10).join(g.of_type(*kinds).select("stix_id", "name"), "stix_id")
    camps = _near(g, g.neighbours("attributed-to", "intrusion-set", source_type="campaign"), "who", 10).join(g.of_type("campaign").select("stix_id", "name"), "stix_id")
    q = lambda verb: F.concat(F.lit(f"Which threat actors {verb} "), "name", F.lit("?"))
    a = lines(F.format_string("%d known actors.", "n_who"), F.col("who"))
    return _pairs(users, q("use"), a).unionByName(_pairs(camps, q("are behind"), a))


def vulnerability_chains(g: Graph) -> DataFrame:
    """Vulnerabilities that technique texts name, with the techniques' users and mitigations."""
    tech = g.of_type("attack-pattern").select("stix_id", "name", F.explode(F.array_distinct(F.regexp_extract_all("description", F.lit(f"({tx.CVE})"), F.lit(1)))).alias("cve"))
    known = tech.join(g.of_type("vulnerability").select(F.col("name").alias("cve")), "cve", "left_semi")
    full = known.join(_near(g, g.technique_actors(), "actors"), "stix_id", "left").join(_near(g, g.technique_mitigations(), "mitigations"), "stix_id", "left")
    return _pairs(full, F.concat(F.lit("How does "), "cve", F.lit(" fit into an attack?")), lines(F.concat("cve", F.lit(" is used in "), "name", F.lit(".")), item("Actors", F.col("actors")), item("Mitigations", F.col("mitigations"))))


def kill_chains(g: Graph) -> DataFrame:
    """The phases of actors with two or more tactics, in order, with their techniques."""
    used = g.actor_techniques().join(g.nodes.select(F.col("stix_id").alias("other_id"), "kill_chain_phases"), "other_id")
    by = used.select("stix_id", "other_name", F.explode("kill_chain_phases").alias("tactic")).groupBy("stix_id", "tactic").agg(names("other_name", 4).alias("few"))
    story = by.groupBy("stix_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct(phase_order(F.col("tactic")).alias("o"), "tactic", "few"))).alias("s")).where("n >= 2").join(g.of_type("intrusion-set").select("stix_id", "name"), "stix_id")
    steps = F.array_join(F.transform("s", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), tx.label(x["tactic"]), F.lit(": "), x["few"])), "\n")
    return _pairs(story, question(F.col("name"), F.col("name"), ["Walk through an attack by {x}.", "Describe the kill chain of {x}."]), lines(F.concat(F.lit("A typical operation of "), "name", F.lit(":")), steps))


def detection_attribution(g: Graph) -> DataFrame:
    """Actors behind a detected technique, and behind two neighbouring ones together."""
    one = _near(g, g.technique_actors(), "who", 10).join(g.of_type("attack-pattern").select("stix_id", "name"), "stix_id")
    single = _pairs(one, F.concat(F.lit("We detected "), "name", F.lit(". Who could it be?")), lines(F.format_string("%d actors use it.", "n_who"), F.col("who")))
    next_ = g.of_type("attack-pattern").select("stix_id", "name").withColumn("k", F.substring_index("stix_id", "--", -1).try_cast("bigint"))
    pairs = next_.alias("x").join(next_.alias("y"), F.col("y.k") == F.col("x.k") + 1).select(F.col("x.stix_id").alias("a"), F.col("y.stix_id").alias("b"), F.col("x.name").alias("na"), F.col("y.name").alias("nb"))
    use = g.technique_actors().select("stix_id", "other_id", "other_name").distinct()
    both = pairs.join(use.select(F.col("stix_id").alias("a"), "other_id", "other_name"), "a").join(use.select(F.col("stix_id").alias("b"), "other_id"), ["b", "other_id"])
    pair = ["a", "b", "na", "nb"]
    both = both.groupBy(*pair).agg(F.count(F.lit(1)).alias("n")).join(few_names(both, pair, "other_name", 10, "who"), pair)
    return single.unionByName(_pairs(both, F.concat(F.lit("We detected "), "na", F.lit(" and "), "nb", F.lit(". Who could it be?")), lines(F.format_string("%d actors use both.", "n"), F.col("who"))))


def mitigations(g: Graph) -> DataFrame:
    """Mitigations of a technique, and those that cover most of an actor's techniques."""
    tech = _near(g, g.technique_mitigations(), "what", 10).join(g.of_type("attack-pattern").select("stix_id", "name"), "stix_id")
    per = g.mitigation_coverage(10).join(g.nodes.select(F.col("stix_id").alias("mitigation"), F.col("name").alias("m")), "mitigation").groupBy("actor").agg(F.array_sort(F.collect_list(F.struct("rank", "m", "covered"))).alias("s")).join(g.nodes.select(F.col("stix_id").alias("actor"), "name"), "actor")
    body = F.array_join(F.transform("s", lambda x: F.concat(x["m"], F.lit(" ("), x["covered"].cast("string"), F.lit(" techniques)"))), "\n")
    return _pairs(tech, F.concat(F.lit("How can "), "name", F.lit(" be mitigated?")), lines(F.col("what"))).unionByName(_pairs(per, F.concat(F.lit("How do we defend against "), "name", F.lit("?")), lines(body)))


def targeting(actors: DataFrame) -> DataFrame:
    """Sectors and victims of actors (name, target_categories, victims, sponsor, motive), and actors by sector or country of two or more."""
    own = actors.where(F.size("target_categories") > 0)
    direct = _pairs(own, question(F.col("name"), F.col("name"), ["What sectors does {x} target?", "Give the targeting profile of {x}."]), lines(item("Target sectors", F.array_join("target_categories", ", ")), item("Known victims", F.array_join(F.slice("victims", 1, 10), ", ")), item("Motivation", F.col("motive")), item("State sponsor", F.col("sponsor"))))

    def reverse(column: str, ask: str) -> DataFrame:
        by = actors.select("name", F.explode(column).alias("k")).groupBy("k").agg(F.count_distinct("name").alias("n"), names("name", 15).alias("who")).where("n >= 2")
        return _pairs(by, F.concat(F.lit(ask), "k", F.lit("?")), lines(F.format_string("%d known actors.", "n"), F.col("who")))

    return direct.unionByName(reverse("target_categories", "Which actors target the sector ")).unionByName(reverse("victims", "Which actors target "))


def rule_coverage(g: Graph, detected: DataFrame) -> DataFrame:
    """How much of an actor's techniques detection rules cover."""
    c = g.detection_coverage(detected).join(g.nodes.select(F.col("stix_id").alias("actor"), "name"), "actor")
    return _pairs(c, F.concat(F.lit("How well do rules cover "), "name", F.lit("?")), lines(F.format_string("%d of %d techniques, %d%% (%s).", "covered", "total", "pct", "tier")))


def logs_to_actors(g: Graph, records: DataFrame) -> DataFrame:
    """Actors behind the technique of a log, and behind all of its first four."""
    from orefold.operators.linking import listed

    keys = g.of_type("attack-pattern").where("attack_id IS NOT NULL").select(F.col("attack_id").alias("tid"), F.col("stix_id").alias("tech"), "name")
    seen = listed(records.where("domain = 'log_analysis'"), "mitre_techniques", "tid").join(keys, "tid")
    one = _near(g, g.technique_actors(), "who", 10).join(seen.select(F.col("tech").alias("stix_id"), "tid", "name").distinct(), "stix_id")
    single = _pairs(one, F.concat(F.lit("Logs show "), "tid", F.lit(". Who could it be?")), lines(F.concat("name", F.lit(" suggests:")), F.col("who")))
    first = seen.withColumn("k", F.row_number().over(Window.partitionBy("record_id").orderBy("tid"))).where("k <= 4")
    asked = first.groupBy("record_id").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("tid")), ", ").alias("tids")).where("n >= 2")
    all_ = g.actors_of_all(first.select(F.col("record_id").alias("group"), "tech")).join(asked.withColumnRenamed("record_id", "group"), "group").join(g.nodes.select(F.col("stix_id").alias("actor"), "name"), "actor").groupBy("group", "tids").agg(names("name", 10).alias("who"))
    return single.unionByName(_pairs(all_, F.concat(F.lit("Logs show "), "tids", F.lit(" together. Who could it be?")), lines(F.col("who"))))


def data_sources(g: Graph) -> DataFrame:
    """What a data component detects."""
    d = _near(g, g.neighbours("detects", "attack-pattern"), "what", 15).join(g.nodes.select("stix_id", "name"), "stix_id")
    return _pairs(d, F.concat(F.lit("What does "), "name", F.lit(" detect?")), lines(F.format_string("%d techniques.", "n_what"), F.col("what")))


def technique_overviews(g: Graph) -> DataFrame:
    """Tactics, subtechniques, users, software and mitigations of each technique."""
    t = g.of_type("attack-pattern").select("stix_id", "name", "kill_chain_phases")
    for column, near in (("subtechniques", g.neighbours("subtechnique-of", "attack-pattern", incoming=True)), ("actors", g.technique_actors()), ("software", g.technique_software()), ("mitigations", g.technique_mitigations())):
        t = t.join(_near(g, near, column), "stix_id", "left")
    parts = [item(x.capitalize(), F.col(x)) for x in ("subtechniques", "actors", "software", "mitigations")]
    return _pairs(t, question(F.col("stix_id"), F.col("name"), ["Give an overview of {x}.", "What is {x}?", "Explain {x}."]), lines(F.col("name"), item("Tactic", F.array_join(F.transform(ordered_phases(F.col("kill_chain_phases")), tx.label), ", ")), *parts))


def software_overviews(g: Graph) -> DataFrame:
    """What a program does and who uses it."""
    s = g.of_type("malware", "tool").select("stix_id", "name", "type").join(_near(g, g.neighbours("uses", "attack-pattern"), "techniques"), "stix_id", "left").join(_near(g, g.neighbours("uses", "intrusion-set", incoming=True), "actors"), "stix_id", "left")
    return _pairs(s, F.concat(F.lit("What is "), "name", F.lit("?")), lines(F.concat("name", F.lit(" is a "), "type", F.lit(".")), item("Techniques", F.col("techniques")), item("Used by", F.col("actors"))))


def actor_overviews(g: Graph) -> DataFrame:
    """Aliases, main tactics, techniques, software and campaigns of each actor."""
    a = g.of_type("intrusion-set").select("stix_id", "name", "aliases")
    for column, near in (("techniques", g.actor_techniques()), ("software", g.actor_software()), ("campaigns", g.actor_campaigns())):
        a = a.join(_near(g, near, column), "stix_id", "left")
    top = g.tactic_counts(5).groupBy(F.col("actor").alias("stix_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "tactic", "n"))), lambda x: F.concat(tx.label(x["tactic"]), F.lit(" ("), x["n"].cast("string"), F.lit(")"))), ", ").alias("tactics"))
    return _pairs(a.join(top, "stix_id", "left"), question(F.col("name"), F.col("name"), ["Who is {x}?", "Brief me on {x}."]), lines(F.col("name"), item("Also known as", F.array_join(F.slice("aliases", 1, 5), ", ")), item("Main tactics", F.col("tactics")), item("Techniques", F.col("techniques")), item("Software", F.col("software")), item("Campaigns", F.col("campaigns"))))


#: The reports that need the graph alone, by number.
REPORTS: dict[int, Callable[[Graph], DataFrame]] = {1: actor_techniques, 2: actor_arsenal, 3: attribution, 4: vulnerability_chains, 5: kill_chains, 6: detection_attribution, 7: mitigations, 11: data_sources, 12: technique_overviews, 13: software_overviews, 14: actor_overviews}


def generate(g: Graph, stored: DataFrame | None = None, numbers: tuple[int, ...] = tuple(REPORTS), most: dict[int, int] | None = None) -> DataFrame:
    """The pairs of several reports with their stored fields, at most most of each, none twice or already stored."""
    out = None
    for n in numbers:
        df = REPORTS[n](g).withColumn("category", F.lit(n))
        if most and n in most:
            df = df.orderBy(F.md5(F.col("user_message").cast("binary")), "assistant_message").limit(most[n])
        out = df if out is None else out.unionByName(df)
    rows = with_metadata(out).withColumn("id", F.struct("category", "user_message", "assistant_message"))
    return dedup_new(rows, stored).drop("id")


def cve_answers(cves: DataFrame) -> DataFrame:
    """Of each published vulnerability a summary and, where the data suffice, an impact and a mitigation answer."""
    c = F.col("containers")
    english = F.filter(c["cna"]["descriptions"], lambda d: F.coalesce(d["lang"], F.lit("en")).startswith("en"))
    text = tx.cut_at_sentence(tx.strip_html(F.get(english, F.lit(0))["value"]))
    base = cves.select(F.col("cveMetadata.cveId").alias("cve"), F.substring("cveMetadata.datePublished", 1, 10).alias("published"), text.alias("text"), feeds.cvss(c).alias("cvss"), feeds.weaknesses(c).alias("cwes"), feeds.products(c).alias("products"), feeds.solution(c).alias("solution"), feeds.patch_urls(c).alias("urls")).where(F.length("text") >= 30)
    score = F.col("cvss.baseScore")
    severity = F.coalesce("cvss.baseSeverity", tx.severity_of_score(score))
    listed = F.array_join(F.transform("cwes", lambda w: F.concat(w["id"], F.when(~F.lower(w["text"]).isin("", "n/a"), F.concat(F.lit(" ("), w["text"], F.lit(")"))).otherwise(""))), ", ")
    fixes = F.array_join(F.transform(F.filter("products", lambda p: F.size(p["fixes"]) > 0), lambda p: F.concat(F.lit("- "), p["vendor"], F.lit(" "), p["product"], F.lit(": "), F.array_join(p["fixes"], ", "))), "\n")
    brief = F.when(F.size("products") > 0, feeds.brief_products(F.col("products")))
    summary = lines(F.concat("cve", F.when(score.isNotNull(), F.concat(F.lit(" ("), F.lower(severity), F.lit(", CVSS "), score.cast("string"), F.lit(")"))).otherwise(""), F.lit(" - "), "text"), item("Weakness", listed), item("Affected", brief), F.when(fixes != "", F.concat(F.lit("Fix versions:\n"), fixes)), item("Published", F.col("published")))
    head = F.when(score.isNotNull(), F.concat("cve", F.lit(" has a CVSS base score of "), score.cast("string"), F.lit(" ("), severity, F.lit(")."))).otherwise(F.concat("cve", F.lit(" is categorized as "), listed, F.lit(".")))
    impact = F.when(score.isNotNull() | (listed != ""), lines(head, F.col("text"), item("Affected products", brief)))
    fix = F.when((fixes != "") | F.col("solution").isNotNull(), lines(F.concat(F.lit("To remediate "), "cve", F.lit(":")), fixes, F.col("solution"), F.when(F.size("urls") > 0, F.concat(F.lit("References:\n- "), F.array_join(F.slice("urls", 1, 5), "\n- ")))))
    ask = lambda kind, templates, a: F.when(a.isNotNull(), F.struct(F.lit(kind).alias("kind"), question(F.col("cve"), F.col("cve"), templates).alias("user_message"), a.alias("assistant_message")))
    rows = F.array_compact(F.array(ask("summary", ["Summarize {x}.", "What is {x}?"], summary), ask("impact", ["What is the impact of {x} and how serious is it?"], impact), ask("mitigation", ["How is {x} mitigated?"], fix)))
    return base.select("cve", F.explode(rows).alias("r")).select("cve", "r.*")


def kev_answers(kev: DataFrame) -> DataFrame:
    """A summary, an impact and a mitigation answer for each exploited vulnerability."""
    product = F.concat_ws(" ", "vendorProject", "product")
    ransom = F.when(F.lower("knownRansomwareCampaignUse") == "known", F.lit("Used in ransomware campaigns."))
    summary = lines(F.concat("cveID", F.lit(" ("), "vulnerabilityName", F.lit(")")), item("Product", product), item("Description", F.col("shortDescription")), ransom, item("Added", F.col("dateAdded")), item("Due", F.col("dueDate")), item("Required action", F.col("requiredAction")), item("Notes", F.col("notes")))
    impact = lines(F.concat("cveID", F.lit(" affects "), product, F.lit(".")), F.col("shortDescription"), F.lit("It is exploited in the wild."), ransom)
    fix = lines(F.concat(F.lit("For "), "cveID", F.lit(":")), item("Required action", F.col("requiredAction")), item("Due", F.col("dueDate")))
    row = lambda kind, q, a: F.struct(F.lit(kind).alias("kind"), F.concat(F.lit(q), "cveID", F.lit("?")).alias("user_message"), a.alias("assistant_message"))
    return kev.select(F.col("cveID").alias("cve"), F.explode(F.array(row("summary", "What is ", summary), row("impact", "What is the impact of ", impact), row("mitigation", "What must be done about ", fix))).alias("r")).select("cve", "r.*")


def review_prompt(records: DataFrame) -> DataFrame:
    """The prompt for one record's review, its texts cut to 2000 and 3000 characters."""
    p = F.concat_ws("\n", F.format_string("--- Record %s (domain: %s) ---", F.col("id").cast("string"), "domain"), F.concat(F.lit("USER: "), F.substring("user_message", 1, 2000)), F.concat(F.lit("ASSISTANT: "), F.substring("assistant_message", 1, 3000)), F.lit("Rate this response. Respond with ONLY the JSON object."))
    return records.select("id", p.alias("prompt"))


def search_query(event: Column, sourcetype: Column) -> Column:
    """a search over the fields that an event (a map) has."""
    field = lambda k: F.try_element_at(event, F.lit(k))
    clause = lambda k: F.when(field(k).isNotNull(), F.concat(F.lit(f'  {k}="'), field(k), F.lit('"')))
    return F.concat_ws("\n", F.concat(F.lit('index=main sourcetype="'), sourcetype, F.lit('"')), *(clause(k) for k in ("process_name", "action", "event_id")), F.lit("| table _time, host, user, process_name, command_line, action, src_ip, dest_ip"), F.lit("| sort -_time"))


def kusto_query(event: Column) -> Column:
    """the same for process or security event tables."""
    field = lambda k: F.try_element_at(event, F.lit(k))
    clause = lambda k, name, op: F.when(field(k).isNotNull(), F.concat(F.lit(f'| where {name} {op} "'), field(k), F.lit('"')))
    process = F.concat_ws("\n", F.lit("DeviceProcessEvents"), F.lit("| where TimeGenerated > ago(1h)"), clause("process_name", "FileName", "=="), F.lit("| sort by TimeGenerated desc"))
    other = F.concat_ws("\n", F.lit("SecurityEvent"), F.lit("| where TimeGenerated > ago(1h)"), clause("action", "Activity", "contains"), clause("event_id", "EventID", "=="), F.lit("| sort by TimeGenerated desc"))
    return F.when(field("process_name").isNotNull() | field("command_line").isNotNull(), process).otherwise(other)


def correlation_query(technique: Column, sourcetypes: Column) -> Column:
    """events of several sources on one host."""
    wanted = F.array_join(F.transform(sourcetypes, lambda s: F.concat(F.lit('sourcetype="'), s, F.lit('"'))), " OR ")
    return F.concat_ws("\n", F.concat(F.lit("index=main ("), wanted, F.lit(")")), F.concat(F.lit('| eval technique="'), technique, F.lit('"')), F.lit("| stats dc(sourcetype) as source_count, values(action) as actions by host"), F.concat(F.lit("| where source_count >= "), F.least(F.size(sourcetypes), F.lit(2)).cast("string")))


def rule_yaml(technique: Column, title: Column, event: Column, level: str = "medium") -> Column:
    """a detection rule with an id from the technique's hash."""
    h = F.md5(technique.cast("binary"))
    rid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    fields = F.array_join(F.transform(F.array_sort(F.map_entries(event)), lambda e: F.concat(F.lit("    "), e["key"], F.lit(": '"), e["value"], F.lit("'"))), "\n")
    return F.concat_ws("\n", F.concat(F.lit("title: "), title), F.concat(F.lit("id: "), rid), F.lit("status: experimental"), F.lit(f"level: {level}"), F.lit("tags:"), F.concat(F.lit("  - attack."), F.lower(technique)), F.lit("detection:"), F.lit("  selection:"), fields, F.lit("  condition: selection"))
