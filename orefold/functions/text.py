"""Text functions: hashes, identifiers, clean-up and parsing, as Column expressions.

Patterns use ASCII classes, as both Spark and the SQL oracle read them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the characters that the contract's whitespace split treats as white space.
WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
#: Identifier patterns.
CVE = r"CVE-\d{4}-\d+"
TECHNIQUE = r"T\d{4}(?:\.\d{3})?"
CWE = r"CWE-\d+"
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
ARTIFACT = r"^(?:[>*]{1,2}\s*)+"
#: Where a response begins, best first, and the tokens that end it.
RESPONSE_MARKERS = ("<|start_header_id|>assistant<|end_header_id|>\n\n", "<|assistant|>\n", "### Assistant:\n")
RESPONSE_ENDS = ("<|eot_id|>", "</s>", "<|end_of_text|>")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none outside."""
    return F.trim(F.regexp_replace(c, WHITE, " "))


def content_hash(user: Column, assistant: Column) -> Column:
    """SHA-256 of both messages, lower case, white space squeezed."""
    return F.sha2(squeeze(F.lower(F.concat(user, F.lit(" "), assistant))).cast("binary"), 256)


def id_list(text: Column, pattern: str) -> Column:
    """Sorted distinct matches as comma-joined text; null if there are none."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    return blank_to_null(F.array_join(F.array_sort(F.array_distinct(found)), ","))


def severity(text: Column) -> Column:
    """A severity word behind "Severity:"; white space before the colon only counts for the first such label."""
    exact = F.upper(F.regexp_extract(text, r"(?i)Severity:\s*(CRITICAL|HIGH|MEDIUM|LOW)", 1))
    loose = F.upper(F.regexp_extract(text, r"(?i)Severity\s*:\s*(\w+)", 1))
    return F.coalesce(blank_to_null(exact), F.when(loose.isin(*SEVERITIES), loose))


def cvss_score(text: Column) -> Column:
    """The number behind "base score:"; null where its digits and dots are no number."""
    return F.regexp_extract(text, r"(?i)(?:CVSS\s+)?base\s+score:\s*([\d.]+)", 1).try_cast("double")


def severity_of_score(score: Column) -> Column:
    return F.when(score >= 9.0, "CRITICAL").when(score >= 7.0, "HIGH").when(score >= 4.0, "MEDIUM").otherwise("LOW")


def strip_artifacts(text: Column) -> Column:
    """Each line without leading runs of > and *."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, ARTIFACT, "")), "\n")


def postprocess_response(text: Column) -> Column:
    return F.regexp_replace(strip_artifacts(text), r"^\s+|\s+$", "")


def response_span(text: Column) -> Column:
    """The response behind the last of the best marker present, up to the first end token; null without a marker."""
    body = F.coalesce(*(F.when(F.instr(text, m) > 0, F.substring_index(text, m, -1)) for m in RESPONSE_MARKERS))
    for end in RESPONSE_ENDS:
        body = F.substring_index(body, end, 1)
    return body


def response(text: Column) -> Column:
    return F.regexp_replace(response_span(text), r"^\s+|\s+$", "")


def token_count(text: Column) -> Column:
    """Tokens of the response by white space, the default of the tokenizer hook; 0 without a response."""
    return F.coalesce(F.size(F.filter(F.split(response(text), r"\s+"), lambda w: w != "")), F.lit(0))


#: Fixed value: a prediction line; white space stays within the line.
PREDICTION = r"(?i)T(\d{4}(?:\.\d{3})?)[^\S\n]*\|[^\S\n]*(\w(?:\w|[^\S\n])*?)[^\S\n]*\|[^\S\n]*(\d+)%?[^\S\n]*\|[^\S\n]*([^\n]+)"
#: Where the truth of a formatted text begins, best first.
TRUTH_MARKERS = ("<|assistant|>", "<|start_header_id|>assistant<|end_header_id|>", "### Assistant:")


def parse_prediction(text: Column) -> Column:
    """The first line "T… | tactic | nn% | explanation" as a struct; null if no line matches."""
    part = lambda i: F.regexp_extract(text, PREDICTION, i)
    found = F.struct(
        F.concat(F.lit("T"), part(1)).alias("technique_id"),
        F.trim(part(2)).alias("tactic"),
        part(3).try_cast("int").alias("confidence"),
        F.trim(part(4)).alias("explanation"),
    )
    return F.when(text.rlike(PREDICTION), found)


def ground_truth(text: Column) -> Column:
    """parse_prediction of the text behind the last of the first marker that gives one, end tokens taken out."""
    found = []
    for marker in TRUTH_MARKERS:
        body = F.when(F.instr(text, marker) > 0, F.substring_index(text, marker, -1))
        for end in RESPONSE_ENDS:
            body = F.replace(body, F.lit(end), F.lit(""))
        found.append(parse_prediction(body))
    return F.coalesce(*found)


def action_of(text: Column, actions: list[str]) -> Column:
    """The action named behind "Action:" if it is one of actions; else the last of actions that stands in the text as a word."""
    named = F.upper(F.regexp_extract(text, r"(?i)Action:\s*(\w+)", 1))
    words = F.upper(text)
    found = [F.when(words.rlike(rf"\b{a}\b"), a) for a in reversed(actions)]
    return F.coalesce(F.when(named.isin(*actions), named), *found)


def strip_html(text: Column) -> Column:
    """Breaks, items and paragraphs as lines, other tags dropped, blank lines squeezed."""
    out = F.regexp_replace(text, r"(?i)<br\s*/?>", "\n")
    out = F.regexp_replace(out, r"(?i)<li\s*>", "- ")
    out = F.regexp_replace(out, r"(?i)<p\s*>", "\n")
    out = F.regexp_replace(out, r"<[^>]+>", "")
    return F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def cut_at_sentence(text: Column, most: int = 2000) -> Column:
    """Texts over most characters end at their last full stop before it."""
    return F.when(F.length(text) > most, F.concat(F.regexp_replace(F.substring(text, 1, most), r"\.[^.]*$", ""), F.lit("."))).otherwise(text)


def first_sentence(text: Column) -> Column:
    return F.regexp_replace(F.substring_index(text, ". ", 1), r"\.+$", "")


def label(slug: Column) -> Column:
    """A hyphenated name as a title."""
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def yaml_field(text: Column, name: str) -> Column:
    """A top-level scalar of a YAML text without quotes; '' if there is none."""
    return F.regexp_replace(F.trim(F.regexp_extract(text, rf"(?m)^{name}:(.*)$", 1)), "^['\"]+|['\"]+$", "")


def rule_techniques(text: Column) -> Column:
    """Technique ids in the tags block of a detection rule; comments may stand between the tags."""
    block = F.regexp_extract(text, r"(?m)^[ \t]*tags:[^\n]*\n((?:[ \t]*(?:- [^\n]*|#[^\n]*)?(?:\n|$))*)", 1)
    found = F.regexp_extract_all(block, F.lit(r"(?im)^[ \t]*- [ \t]*attack\.(t\d{4}(?:\.\d{3})?)[ \t]*$"), F.lit(1))
    return F.transform(found, F.upper)


def rule_field(text: Column, name: str, default: str) -> Column:
    """The last value of a rule's field."""
    found = F.regexp_extract_all(text, F.lit(rf"(?m)^[ \t]*{name}:[ \t]*(.*?)[ \t\r]*$"), F.lit(1))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(default))


#: Ranks of rule states and levels; 5 for any other.
RULE_STATUS = {"stable": 0, "test": 1, "experimental": 2, "deprecated": 3}
RULE_LEVEL = {"critical": 0, "high": 1, "medium": 2, "low": 3, "informational": 4}


def rank(value: Column, ranks: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for k, v in ranks.items():
        out = F.when(value == k, v).otherwise(out)
    return out


def rule_score(status: Column, level: Column) -> Column:
    return rank(status, RULE_STATUS, 5) * 10 + rank(level, RULE_LEVEL, 5)


def strip_fences(text: Column) -> Column:
    """A model's answer without its code fence."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", "")


def strip_cwe_prefix(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"^CWE-\d+\s*", ""))


def action_id(action: Column, actions: list[str]) -> Column:
    """The place of an action in the list; 0 if it is not there."""
    return F.greatest(F.array_position(F.array(*map(F.lit, actions)), action) - 1, F.lit(0)).cast("int")


def date_of(stamp: Column) -> Column:
    """The date of an ISO time."""
    return F.substring(stamp, 1, 10)


def file_stamp(at: Column) -> Column:
    """A time as a part of file names."""
    return F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")


def listed_json(cell: Column, kind: str = "array<string>") -> Column:
    """A JSON list, empty for null and for text that is none."""
    return F.coalesce(F.from_json(cell, kind), F.array().cast(kind))


def text_values(cell: Column) -> Column:
    """The members of a JSON object as a map; lists, objects and nulls are left out."""
    members = F.coalesce(F.from_json(cell, "map<string,string>"), F.create_map().cast("map<string,string>"))
    return F.map_filter(members, lambda k, x: x.isNotNull() & ~x.rlike(r"(?s)^[\[{].*[\]}]$"))
