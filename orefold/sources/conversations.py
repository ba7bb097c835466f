"""Conversation sources: JSONL, Markdown, Parquet datasets and directories of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.operators.records import MESSAGES, pairs_of_messages


def messages_of_json(line: Column) -> Column:
    """The messages of a line that holds an object with messages or a bare array; null for anything else."""
    v = F.try_parse_json(line)
    nested = F.try_variant_get(v, "$.messages", "variant").cast("string")
    return F.from_json(F.coalesce(nested, v.cast("string")), MESSAGES)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One row per line but blank and # lines: value, messages (null for lines that hold none), file, split.

    The split is train where the file's name says so, else val.
    """
    name = F.col("_metadata.file_name")
    lines = spark.read.text(path).select("value", name.alias("file"))
    kept = lines.where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    return kept.withColumns({"messages": messages_of_json(F.col("value")), "split": F.when(F.col("file").contains("train"), "train").otherwise("val")})


def pairs(df: DataFrame) -> DataFrame:
    """Rows whose last user and last assistant messages both hold text."""
    out = pairs_of_messages(df.where("messages IS NOT NULL"))
    return out.where("user_message <> '' AND assistant_message <> ''")


def skipped(df: DataFrame) -> DataFrame:
    """How many lines of each file held no messages."""
    return df.groupBy("file").agg(F.count_if(F.col("messages").isNull()).alias("bad_lines"))


def with_system(messages: Column, prompt: str) -> Column:
    """messages with a system turn in front where there is none."""
    system = F.array(F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content")))
    return F.when(F.exists(messages, lambda m: m["role"] == "system"), messages).otherwise(F.concat(system, messages))


def messages_of_markdown(block: Column) -> Column:
    """Turns "**role**: text" of a block; comments are dropped."""
    text = F.regexp_replace(block, r"(?s)<!--.*?-->", "")
    turns = F.regexp_extract_all(text, F.lit(r"(?s)(\*\*\w+\*\*:.*?)(?=\n\s*\*\*\w+\*\*:|\z)"), F.lit(1))
    turn = lambda t: F.struct(F.lower(F.regexp_extract(t, r"^\*\*(\w+)\*\*:", 1)).alias("role"), F.trim(F.regexp_replace(F.regexp_replace(t, r"^\*\*\w+\*\*:\s*", ""), r"\s+$", "")).alias("content"))
    return F.transform(turns, turn)


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """One row per conversation: blocks between --- lines that hold turns."""
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    blocks = whole.select("file", F.posexplode(F.split("value", r"\n---[ \t]*\n")).alias("pos", "value"))
    return blocks.withColumn("messages", messages_of_markdown(F.col("value"))).where(F.size("messages") > 0)


def read_directory(spark: SparkSession, path: str, prompt: str) -> DataFrame:
    """All *.md but README.md, then all *.jsonl of a directory, as file and messages with a system turn."""
    md = read_markdown(spark, f"{path}/*.md").where("file <> 'README.md'").select("file", "messages")
    rows = read_jsonl(spark, f"{path}/*.jsonl").where("messages IS NOT NULL").select("file", "messages")
    return md.unionByName(rows).withColumn("messages", with_system(F.col("messages"), prompt))


#: Roles of the older conversation layout.
ROLES = {"human": "user", "gpt": "assistant"}


def messages_of_sharegpt(conversations: Column) -> Column:
    roles = F.create_map(*(F.lit(x) for kv in ROLES.items() for x in kv))
    return F.transform(conversations, lambda m: F.struct(F.coalesce(roles[m["from"]], m["from"]).alias("role"), m["value"].alias("content")))


def render(messages: Column, begin: str = "", turn: str = "<|{role}|>\n{content}</s>\n", end: str = "") -> Column:
    """messages as one text by a chat template."""
    head, _, rest = turn.partition("{role}")
    middle, _, tail = rest.partition("{content}")
    joined = F.array_join(F.transform(messages, lambda m: F.concat(F.lit(head), m["role"], F.lit(middle), F.coalesce(m["content"], F.lit("")), F.lit(tail))), "")
    return F.concat(F.lit(begin), joined, F.lit(end))


def formatted(df: DataFrame, **template: str) -> DataFrame:
    """text of a dataset by the layout its columns show: messages, conversations or text, in this order."""
    if "messages" in df.columns:
        return df.select(render(F.col("messages"), **template).alias("text"))
    if "conversations" in df.columns:
        return df.select(render(messages_of_sharegpt(F.col("conversations")), **template).alias("text"))
    if "text" in df.columns:
        return df.select("text")
    raise ValueError("no messages, conversations or text column")


def image_of(content: Column) -> Column:
    """The first image of a content list of {type, image, text} parts."""
    return F.get(F.filter(content, lambda p: p["type"] == "image"), F.lit(0))["image"]


def multimodal(prompt: Column, image: Column, answer: Column) -> Column:
    part = lambda kind, img, txt: F.struct(F.lit(kind).alias("type"), img.alias("image"), txt.alias("text"))
    none = F.lit(None).cast("string")
    user = F.struct(F.lit("user").alias("role"), F.array(part("image", image, none), part("text", none, prompt)).alias("content"))
    assistant = F.struct(F.lit("assistant").alias("role"), F.array(part("text", none, answer)).alias("content"))
    return F.array(user, assistant)


#: Folders that are looked at where no path is given.
DEFAULT_FOLDERS = ("prepared", "dataset")


def read_dataset(spark: SparkSession, path: str | None = None, base: str = ".") -> DataFrame:
    """messages of a .jsonl file, a dataset folder, or the first default folder below base that is there."""
    from orefold.sources.landing import exists

    if path is None:
        path = next((f"{base}/{x}" for x in DEFAULT_FOLDERS if exists(spark, f"{base}/{x}")), None)
        if path is None:
            raise FileNotFoundError(f"no dataset below {base}")
    if path.endswith(".jsonl"):
        return read_jsonl(spark, path).where("messages IS NOT NULL").select("messages")
    return spark.read.parquet(path)


def read_splits(spark: SparkSession, path: str, share: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows of a prepared folder; a folder without splits is split by a seeded order of its rows."""
    from orefold.functions.ids import bucket
    from orefold.sources.landing import exists

    if exists(spark, f"{path}/train"):
        rest = "validation" if exists(spark, f"{path}/validation") else "test"
        return spark.read.parquet(f"{path}/train"), spark.read.parquet(f"{path}/{rest}")
    df = spark.read.parquet(path)
    place = bucket(F.to_json(F.struct(*df.columns)), 1000)
    return df.where(place < round(1000 * share)), df.where(place >= round(1000 * share))
