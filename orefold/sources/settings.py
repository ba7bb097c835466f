"""Settings files: nested sections of scalars and lists, as name and value rows, and typed defaults over them."""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import DataFrame, SparkSession

_LINE = re.compile(r"^(\s*)(- |[^\s:#][^:]*:(?:\s|$))?(.*)$")


def _scalar(text: str) -> str:
    text = text.strip()
    if text[:1] in ("'", '"') and (end := text.find(text[0], 1)) > 0:
        return text[1:end]
    return re.sub(r"\s+#.*$", "", text) if not text.startswith("#") else ""


def parse(text: str) -> dict[str, str]:
    """Dotted names and values of indented sections; lists are joined by commas."""
    out: dict[str, str] = {}
    path: list[tuple[int, str]] = []
    for raw in text.splitlines():
        m = _LINE.match(raw)
        if not raw.strip() or raw.lstrip().startswith("#") or not m[2]:
            continue
        depth, value = len(m[1]), _scalar(m[3])
        if m[2] == "- ":
            name = ".".join(k for _, k in path)
            out[name] = f"{out[name]},{value}" if out.get(name) else value
            continue
        while path and path[-1][0] >= depth:
            path.pop()
        path.append((depth, m[2].rstrip().rstrip(":").strip()))
        if value:
            out[".".join(k for _, k in path)] = value
    return out


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """name and value of every scalar and list of a settings file; settings are few by nature."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    return spark.createDataFrame(sorted(parse(text).items()), "name string, value string")


def apply(defaults, found: dict[str, str], prefix: str = ""):
    """A dataclass of defaults with the values that found names, of the defaults' types."""
    new = {}
    for f in dataclasses.fields(defaults):
        have, name = getattr(defaults, f.name), prefix + f.name
        if dataclasses.is_dataclass(have):
            new[f.name] = apply(have, found, f"{name}.")
        elif name in found:
            raw = found[name]
            new[f.name] = raw.lower() in ("true", "yes", "on") if isinstance(have, bool) else tuple(raw.split(",")) if isinstance(have, tuple) else type(have)(raw)
    return dataclasses.replace(defaults, **new)
