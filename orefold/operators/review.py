"""Review by a caller's model: prompts go out in batches, scores and descriptions come back."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.functions import text as tx
from orefold.operators.graph import Graph

DIMENSIONS = ("accuracy", "completeness", "clarity", "relevance", "usefulness")
SCORES = T.StructType([*(T.StructField(d, T.IntegerType()) for d in DIMENSIONS), T.StructField("notes", T.StringType())])

#: Takes (user message, answer) pairs, gives a JSON object for each, or one JSON array.
Reviewer = Callable[[list[tuple[str, str]]], str]


def stub(pairs: list[tuple[str, str]]) -> str:
    """A reviewer without a model: scores follow the answer's length, the same on every run."""
    rows = []
    for _, answer in pairs:
        n = min(5, 1 + len(answer or "") // 50)
        rows.append({d: n for d in DIMENSIONS} | {"notes": ""})
    return json.dumps(rows)


def scores_of(answer: Column) -> Column:
    """The scores of a model's answer, an object or an array, without code fences; null if it is neither."""
    body = tx.strip_fences(answer)
    many = F.from_json(F.when(body.startswith("["), body), T.ArrayType(SCORES))
    one = F.from_json(F.when(body.startswith("{"), body), SCORES)
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)))


def review(records: DataFrame, reviewer: Reviewer = stub, batch: int = 5) -> DataFrame:
    """id and quality_scores; a batch whose answer has another number of scores is asked again one by one."""
    import pandas as pd

    schema = T.StructType([T.StructField("id", records.schema["id"].dataType), T.StructField("quality_scores", SCORES)])

    def parse(text: str) -> list[dict]:
        text = text.strip().removeprefix("```json").removeprefix("```").removesuffix("```")
        found = json.loads(text)
        return found if isinstance(found, list) else [found]

    def clean(row: dict | None) -> dict | None:
        return None if row is None else {d: int(row[d]) if row.get(d) is not None else None for d in DIMENSIONS} | {"notes": row.get("notes")}

    def ask(pairs: list[tuple[str, str]]) -> list[dict | None]:
        try:
            found = parse(reviewer(pairs))
        except ValueError:
            found = []
        if len(found) == len(pairs):
            return found
        return [None] if len(pairs) == 1 else [ask([p])[0] for p in pairs]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pairs = list(zip(pdf["user_message"], pdf["assistant_message"]))
            found = [clean(x) for i in range(0, len(pairs), batch) for x in ask(pairs[i : i + batch])]
            yield pd.DataFrame({"id": pdf["id"], "quality_scores": pd.Series(found, index=pdf.index, dtype=object)})

    return records.select("id", "user_message", "assistant_message").mapInPandas(run, schema)


def empty_descriptions(nodes: DataFrame, force: bool = False) -> DataFrame:
    return nodes if force else nodes.where(F.coalesce("description", F.lit("")) == "")


def contexts(g: Graph, strategies: DataFrame) -> DataFrame:
    """For each strategy its first linked technique, with up to five users, mitigations and programs."""
    linked = g.neighbours("detects", "attack-pattern").join(strategies.select("stix_id"), "stix_id", "left_semi")
    first = linked.groupBy("stix_id").agg(F.min_by(F.struct("other_id", "other_name"), "other_id").alias("t")).select("stix_id", F.col("t.other_id").alias("tech"), F.col("t.other_name").alias("technique"))
    out = first
    for column, near in (("actors", g.technique_actors()), ("mitigations", g.technique_mitigations()), ("software", g.technique_software())):
        few = near.groupBy(F.col("stix_id").alias("tech")).agg(F.slice(F.array_sort(F.collect_set("other_name")), 1, 5).alias(column))
        out = out.join(few, "tech", "left")
    return out.drop("tech")


def context_prompt() -> Column:
    """The prompt of one context row."""
    listed = lambda title, c: F.when(F.size(F.col(c)) > 0, F.concat(F.lit(f"{title}: "), F.array_join(c, ", ")))
    return F.concat_ws("\n", F.concat(F.lit("Technique: "), "technique"), listed("Actors", "actors"), listed("Mitigations", "mitigations"), listed("Software", "software"))


def batch_prompts(rows: DataFrame, size: int = 5) -> DataFrame:
    """batch, ids and prompt: contexts in groups of size, numbered inside hash buckets so no task sees all rows."""
    b = F.pmod(F.xxhash64("stix_id"), F.lit(64))
    w = Window.partitionBy("bucket").orderBy("stix_id")
    numbered = rows.withColumn("prompt", context_prompt()).withColumn("bucket", b).withColumn("batch", F.concat_ws("-", "bucket", F.floor((F.row_number().over(w) - 1) / size)))
    return numbered.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("stix_id", "prompt"))).alias("p")).select("batch", F.transform("p", lambda x: x["stix_id"]).alias("ids"), F.array_join(F.transform("p", lambda x: F.concat(F.lit("### "), x["stix_id"], F.lit("\n"), x["prompt"])), "\n\n").alias("prompt"))


def descriptions_of(answer: Column, ids: Column, shortest: int = 50) -> Column:
    """id and text pairs of a batch answer: a JSON array of {id, description}, else the texts behind each id."""
    kind = "array<struct<id:string,description:string>>"
    parsed = F.from_json(tx.strip_fences(answer), kind)
    split = F.transform(ids, lambda i: F.struct(i.alias("id"), F.trim(F.regexp_replace(F.split_part(F.split_part(answer, i, F.lit(-1)), F.lit("###"), F.lit(1)), r"^[\s:*#]+|\s+$", "")).alias("description")))
    found = F.coalesce(F.when(F.size(parsed) > 0, parsed), F.filter(split, lambda x: F.contains(answer, x["id"])))
    return F.filter(found, lambda x: F.length(x["description"]) > shortest)


def routed(records: DataFrame, by: str, reviewers: dict[str, Reviewer], default: Reviewer | None = None, batch: int = 5) -> DataFrame:
    """id, provider and quality_scores: each record goes to the client that its column names.

    Clients are the caller's; a name without a client goes to the default, or is an error without one.
    """
    named = [r[by] for r in records.select(by).distinct().collect()]
    unknown = [n for n in named if n not in reviewers]
    if unknown and default is None:
        raise KeyError(f"no client for {unknown}")
    out = None
    for name, client in {**reviewers, **({None: default} if default is not None else {})}.items():
        part = records.where(F.col(by) == name) if name is not None else records.where(F.col(by).isNull() | ~F.col(by).isin(list(reviewers)))
        scored = review(part, client, batch).withColumn("provider", F.lit(name or "default"))
        out = scored if out is None else out.unionByName(scored)
    return out
