"""Sources over landed files, and streams against their batch forms."""

from __future__ import annotations

import json

from orefold.plans import reports
from orefold.sources import conversations, feeds, sinks
from orefold.streaming import metrics as live
from pyspark.sql import functions as F


def test_jsonl_lines(spark, tmp_path):
    turn = lambda r, c: {"role": r, "content": c}
    rows = [json.dumps({"messages": [turn("user", "a"), turn("user", "b"), turn("assistant", "c")]}), json.dumps([turn("user", "d"), turn("assistant", "e")]), "", "# note", "{bad", json.dumps({"x": 1}), json.dumps([turn("user", "f"), turn("assistant", "")])]
    (tmp_path / "train.jsonl").write_text("\n".join(rows))
    df = conversations.read_jsonl(spark, str(tmp_path / "train.jsonl"))
    assert sorted((r.user_message, r.assistant_message, r.split) for r in conversations.pairs(df).collect()) == [("b", "c", "train"), ("d", "e", "train")]
    assert conversations.skipped(df).first().bad_lines >= 1


def test_markdown_and_directory(spark, tmp_path):
    (tmp_path / "a.md").write_text("<!-- only a comment -->\n---\n**user**: hi\nthere\n**assistant**: yes\n---\n**system**: s\n**user**: q\n")
    (tmp_path / "README.md").write_text("**user**: no\n")
    (tmp_path / "b.jsonl").write_text(json.dumps([{"role": "user", "content": "z"}]))
    got = [[(m.role, m.content) for m in r.messages] for r in conversations.read_directory(spark, str(tmp_path), "P").collect()]
    assert sorted(got) == sorted([[("system", "P"), ("user", "hi\nthere"), ("assistant", "yes")], [("system", "s"), ("user", "q")], [("system", "P"), ("user", "z")]])


def test_bundle(spark, tmp_path):
    objects = [
        {"type": "intrusion-set", "id": "i1", "name": "Alpha", "aliases": ["alpha", "A1", "a1"], "external_references": [{"source_name": "mitre-attack", "external_id": "G0001"}, {"source_name": "x", "external_id": "1"}, {"source_name": "x", "external_id": "2"}]},
        {"type": "attack-pattern", "id": "t1", "name": "Tech", "kill_chain_phases": [{"kill_chain_name": "other", "phase_name": "no"}, {"kill_chain_name": "mitre-attack", "phase_name": "execution"}]},
        {"type": "tool", "id": "x1", "name": "Old", "revoked": True},
        {"type": "relationship", "id": "r1", "source_ref": "i1", "target_ref": "t1", "relationship_type": "uses"},
        {"type": "relationship", "id": "r2", "source_ref": "i1", "target_ref": "x1", "relationship_type": "uses"},
    ]
    (tmp_path / "b.json").write_text(json.dumps({"objects": objects}))
    active = feeds.read_bundle(spark, str(tmp_path / "b.json"))
    nodes = {r.stix_id: r for r in feeds.nodes_of_bundle(active).collect()}
    assert set(nodes) == {"i1", "t1"} and nodes["i1"].aliases == ["A1"] and nodes["t1"].kill_chain_phases == ["execution"]
    assert nodes["i1"].external_ids == {"mitre_attack_id": ["G0001"], "x": ["2"]}
    assert feeds.edges_of_bundle(active).count() == 2


def test_cve_answers(spark, tmp_path):
    cna = {"descriptions": [{"lang": "en", "value": "A <b>flaw</b> in the parser lets attackers run code."}], "metrics": [{"cvssV3_0": {"baseScore": 5.0}}], "affected": [{"vendor": "v", "product": "p", "versions": [{"status": "affected", "version": "1.0", "lessThan": "1.2"}, {"status": "affected", "version": "abc", "versionType": "git", "lessThan": "def"}]}], "solutions": [{"value": "<p>Update</p>"}], "problemTypes": [{"descriptions": [{"cweId": "CWE-79", "description": "CWE-79 Scripting"}]}]}
    good = {"cveMetadata": {"state": "PUBLISHED", "cveId": "CVE-2024-1", "datePublished": "2024-05-01T00:00:00Z"}, "containers": {"cna": cna, "adp": [{"metrics": [{"cvssV3_1": {"baseScore": 9.8, "baseSeverity": "CRITICAL"}}]}]}}
    (tmp_path / "2024").mkdir()
    (tmp_path / "2024" / "CVE-2024-1.json").write_text(json.dumps(good))
    (tmp_path / "2024" / "CVE-2024-2.json").write_text(json.dumps({**good, "cveMetadata": {"state": "REJECTED", "cveId": "CVE-2024-2"}}))
    cves = feeds.read_cves(spark, str(tmp_path))
    got = {r.kind: r.assistant_message for r in reports.cve_answers(cves).collect()}
    assert set(got) == {"summary", "impact", "mitigation"}
    assert "critical, CVSS 9.8" in got["summary"] and "CWE-79 (Scripting)" in got["summary"] and "1.2" in got["mitigation"] and "def" not in got["mitigation"]
    assert feeds.read_cves(spark, str(tmp_path), 2023, 2024).count() == 1


def test_kev_actions_and_sinks(spark, tmp_path):
    (tmp_path / "kev.json").write_text(json.dumps({"vulnerabilities": [{"cveID": "CVE-1", "product": "p", "vendorProject": "v", "knownRansomwareCampaignUse": "Known"}]}))
    rows = reports.kev_answers(feeds.read_kev(spark, str(tmp_path / "kev.json"))).collect()
    assert len(rows) == 3 and any("ransomware" in r.assistant_message for r in rows)
    (tmp_path / "a.csv").write_text("episode,frame_index,frame_path,action,timestamp\n1,0,x,UP,1\n1,0,y,DOWN,2\n")
    assert [r.action for r in feeds.read_actions(spark, str(tmp_path / "a.csv")).collect()] == ["DOWN"]
    df = spark.createDataFrame([("ü", "b")], "user_message string, assistant_message string")
    sinks.export_jsonl(df, str(tmp_path / "out"))
    assert "ü" in spark.read.text(str(tmp_path / "out")).first().value
    sinks.export_parquet(df, str(tmp_path / "parquet"))
    assert spark.read.parquet(str(tmp_path / "parquet" / "train")).first().messages[1].content == "b"
    assert sinks.export_splits(df.withColumn("split", F.lit("train")), str(tmp_path / "splits")) == {"train": 1}
    stamped = sinks.stamp_exported(spark.createDataFrame([(1, None), (2, None)], "id int, exported_at timestamp"), spark.createDataFrame([(1,)], "id int"), "2024-01-01")
    assert [r.exported_at is not None for r in stamped.orderBy("id").collect()] == [True, False]
    assert sinks.history_row(spark, "2024-01-01", {"a": 2}, {"a": 1.0}, "p").first().record_count == 2
    assert '"n":1' in sinks.manifest(df, "user_message")
    assert sinks.newest(["b1", "b3", "b2"], 2) == (["b3", "b2"], ["b1"])
    t = spark.createDataFrame([(1, "x"), (2, None)], "id int, domain string")
    assert [r.id for r in sinks.delete_where(t, "domain = 'x'").collect()] == [2]


def _events(spark):
    kinds = ["metrics", "train_begin", "metrics", "train_end", "metrics"]
    rows = [(f"r{i % 3}", i, kinds[(i // 3) % 5], i, float(i % 17)) for i in range(90)]
    return spark.createDataFrame(rows, "run_id string, seq long, event string, t long, metric double").select("run_id", "seq", "event", F.timestamp_seconds("t").alias("ts"), F.lit(0).alias("step"), "metric")


def _stream(spark, tmp_path):
    for i in range(3):
        _events(spark).where(f"seq >= {30 * i} AND seq < {30 * (i + 1)}").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    return live.read_events(spark, str(tmp_path / "in"), per_trigger=1)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_run_state_streamed(spark, tmp_path):
    got = live.run_available(live.run_state(_stream(spark, tmp_path)), "state_test", "complete", str(tmp_path / "ck"))
    assert _rows(got) == _rows(live.run_state(_events(spark)))


def test_rolling_streamed(spark, tmp_path):
    got = live.run_available(live.rolling_stream(_stream(spark, tmp_path), 7, 3), "rolling_test", "append", str(tmp_path / "ck"))
    close = lambda rows: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows]
    assert close(_rows_none(got)) == close(_rows_none(live.rolling_batch(_events(spark), 7, 3)))


def _rows_none(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def test_ring_and_fan_out(spark, tmp_path):
    seen = []
    sink = live.fan_out(live.keep_ring(spark, str(tmp_path / "ring"), 40), lambda b, n: seen.append(b.count()))
    _stream(spark, tmp_path).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    last = spark.read.parquet(str(tmp_path / "ring" / f"batch={len(seen) - 1}"))
    assert sum(seen) == 90 and last.count() == 40 and len(seen) == 3
