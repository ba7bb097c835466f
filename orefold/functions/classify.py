"""Classification of prompt and answer pairs by ordered rules; the order is part of the meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orefold.functions import text as tx
from orefold.functions.rules import Matches, first_match, first_match_sql, holds

DOMAINS = ("cve", "mitre_attack", "secure_code_review", "apt_intel", "exploitdb", "stix_general", "security_general", "log_analysis", "siem_queries", "sigma_rules")

# The words and patterns of each domain, first match wins. user, answer and both are the texts, user_low and so on the same in lower case.
DOMAIN_RULES = (
    ("sigma_rules", holds("user_low", "sigma rule", "sigma detection", "write a sigma", "logsource:", "detection:")),
    ("siem_queries", holds("user_low", "write a splunk", "write a spl", "write a kql", "detection query", "correlation search", "write a correlation", "detection rule for", "detection engineer", "analytics rule", "spl query", "kql query", "splunk spl", "spl correlation", "spl detection", "sentinel kql", "sentinel analytics", "splunk search", "splunk detection", "splunk administrator", "tstats query", "tstats search", "data model", "this splunk spl", "this splunk detection", "this splunk search")),
    ("siem_queries", holds("answer_low", "```spl", "```splunk", "sourcetype=", "index=main")),
    ("log_analysis", holds("user_low", "analyze the following", "triage this", "identify any malicious", "correlate them", "correlated security events", "analyze this", "correlating alerts", "triaging a batch", "triage result", "review the following", "correlate these", "security events from different", "mdr analyst")),
    (
        "apt_intel",
        Matches("user", r"APT\d+")
        | Matches("both", r"\bG\d{4}\b")
        | holds("both", "intrusion-set")
        | holds("user_low", "threat actor", "threat group", "apt group", "brief me on", "who is", "which group", "nation-state", "intrusion set", "what malware", "what tools does", "what country", "threat intelligence", "state sponsor", "what sectors", "known victims", "known aliases", "same group as", "targeting profile", "software arsenal"),
    ),
    ("cve", Matches("both", tx.CVE)),
    ("mitre_attack", Matches("both", tx.TECHNIQUE) | holds("both", "ATT&CK", "attack-pattern")),
    ("secure_code_review", holds("user", "Is this", "Is using", "Is parsing", "safe?", "secure?", "code review")),
    ("exploitdb", holds("both", "ExploitDB", "EDB-ID") | holds("both_low", "exploit-db")),
    ("stix_general", holds("both", "STIX", "TAXII")),
)

# The question types, first match wins.
QUESTION_RULES = (
    ("sigma_explain", holds("user_low", "sigma") & holds("user_low", "explain", "what does")),
    ("sigma_write", holds("user_low", "sigma") & holds("user_low", "write", "create", "detect")),
    ("kql_query", holds("user_low", "kql", "kusto", "sentinel")),
    ("spl_query", holds("user_low", "spl", "splunk", "correlation search")),
    ("log_correlation", holds("user_low", "correlate", "correlation")),
    ("log_triage", holds("user_low", "triage", "analyze the following", "analyze this", "identify any malicious", "which are suspicious")),
    ("group_profile", holds("user_low", "who is", "brief me on", "threat intelligence briefing", "overview of", "what is known about the threat")),
    ("ttp_mapping", holds("user_low", "what techniques does") | holds("user_low", "techniques") & holds("user_low", "use")),
    ("detection_guidance", holds("user_low", "detect") & holds("user_low", "activity", "monitor", "indicators")),
    ("software_analysis", holds("user_low", "what malware", "what tools", "software arsenal")),
    ("campaign_analysis", holds("user_low", "campaign") & holds("user_low", "describe", "analysis", "what is known")),
    ("attribution", holds("user_low", "what country", "state sponsor", "nation-state", "operate from", "attribution")),
    ("alias_lookup", holds("user_low", "same group", "aliases", "also known", "tracked")),
    ("targeting", holds("user_low", "what sectors", "what industries", "victims", "targeting profile")),
    ("impact", holds("user_low", "impact") & holds("user_low", "serious")),
    ("mitigation", holds("user_low", "mitigat")),
    ("summary", holds("user_low", "summarize", "summary")),
    ("explanation", holds("user_low", "explain") & holds("user_low", "plain language")),
    ("tactic_lookup", holds("user_low", "tactic") & holds("user_low", "belong")),
    ("technique_description", holds("user_low", "describe the technique")),
    ("code_review", holds("user_low", "safe", "secure")),
)


def texts(user: Column, answer: Column) -> dict[str, Column]:
    both = F.concat(user, F.lit(" "), answer)
    return {"user": user, "answer": answer, "both": both, "user_low": F.lower(user), "answer_low": F.lower(answer), "both_low": F.lower(both)}


def sql_texts(user: str = "user_message", answer: str = "assistant_message") -> dict[str, str]:
    both = f"({user} || ' ' || {answer})"
    return {"user": user, "answer": answer, "both": both, "user_low": f"lower({user})", "answer_low": f"lower({answer})", "both_low": f"lower({both})"}


def domain(user: Column, answer: Column) -> Column:
    return first_match(DOMAIN_RULES, "security_general", texts(user, answer))


def question_type(user: Column) -> Column:
    return first_match(QUESTION_RULES, "other", {"user_low": F.lower(user)})


def domain_sql(**names: str) -> str:
    return first_match_sql(DOMAIN_RULES, "security_general", sql_texts(**names))


def question_type_sql(user: str = "user_message") -> str:
    return first_match_sql(QUESTION_RULES, "other", {"user_low": f"lower({user})"})


def metadata(user: Column, answer: Column) -> dict[str, Column]:
    """The stored fields of a pair; severity and score are read from the answer alone."""
    both = F.concat(user, F.lit(" "), answer)
    return {
        "domain": domain(user, answer),
        "question_type": question_type(user),
        "cve_ids": tx.id_list(both, tx.CVE),
        "mitre_techniques": tx.id_list(both, tx.TECHNIQUE),
        "cwe_ids": tx.id_list(both, tx.CWE),
        "severity": tx.severity(answer),
        "cvss_score": tx.cvss_score(answer),
        "char_length": F.length(both),
        "content_hash": tx.content_hash(user, answer),
    }
