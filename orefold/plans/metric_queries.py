"""Queries over evaluation metrics, live metric state and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from orefold.operators import metrics
from orefold.plans.views import view, with_views
from orefold.sources import conversations
from orefold.sources.landing import new_folder
from orefold.streaming import metrics as live

Q, SQL = {}, {}
PREDS, METRICS, FRAMES = with_views("v_preds"), with_views("v_metrics"), with_views("v_frames")


def add(name, sql=None):
    def keep(f):
        Q[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def preds(spark, d):
    return view(spark, d, "v_preds")


def _right():
    return F.col("truth") == F.col("pred")


_CLASSES = ", c AS (SELECT label, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, sum(s) AS support FROM (SELECT truth AS label, CAST(truth = pred AS INT) AS tp, 0 AS fp, CAST(truth <> pred AS INT) AS fn, 1 AS s FROM v_preds UNION ALL SELECT pred, 0, CAST(truth <> pred AS INT), 0, 0 FROM v_preds) GROUP BY label), m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM c), f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m) "


@add("A17_classification", PREDS.rstrip() + _CLASSES + "SELECT label, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(support AS BIGINT) AS support, precision, recall, f1 FROM f")
def _(spark, d):
    return metrics.classification(preds(spark, d))


@add("A17_macro_f1", PREDS.rstrip() + _CLASSES + "SELECT avg(f1) AS macro_f1, count(*) AS classes FROM f")
def _(spark, d):
    return metrics.macro(metrics.classification(preds(spark, d)))


@add("A17_accuracy", PREDS + "SELECT count(*) AS n, count(*) FILTER (WHERE lower(truth) = lower(pred)) AS \"right\", count(*) FILTER (WHERE lower(truth) = lower(pred)) / count(*) AS accuracy FROM v_preds")
def _(spark, d):
    return metrics.accuracy(preds(spark, d))


_BIN = ", b AS (SELECT CAST(floor(confidence * 10) AS INT) AS bin, count(*) AS n, avg(confidence) AS avg_conf, avg(CAST(truth = pred AS DOUBLE)) AS avg_acc FROM v_preds WHERE floor(confidence * 10) BETWEEN 0 AND 9 GROUP BY 1) "


@add("A18_reliability_bins", PREDS.rstrip() + _BIN + "SELECT bin, n, round(avg_conf, 9) AS avg_conf, round(avg_acc, 9) AS avg_acc FROM b")
def _(spark, d):
    b = metrics.reliability_bins(preds(spark, d), "confidence", _right())
    return b.select("bin", "n", F.round("avg_conf", 9).alias("avg_conf"), F.round("avg_acc", 9).alias("avg_acc"))


@add("A18_A19_ece", PREDS.rstrip() + _BIN + "SELECT round(sum(n * abs(avg_acc - avg_conf)) / (SELECT count(*) FROM v_preds), 9) AS ece, (SELECT count(*) FROM v_preds) AS total FROM b")
def _(spark, d):
    return metrics.ece(preds(spark, d), "confidence", _right()).select(F.round("ece", 9).alias("ece"), "total")


@add("A20_confusion", PREDS + "SELECT truth, " + ", ".join(f"count(*) FILTER (WHERE pred = '{p}') AS \"{p}\"" for p in "AFNOR") + " FROM v_preds GROUP BY truth")
def _(spark, d):
    return metrics.confusion(preds(spark, d), "truth", "pred", list("AFNOR"))


@add("A21_entropy", PREDS + ", c AS (SELECT pred, count(*) AS n FROM v_preds GROUP BY pred) SELECT round(-sum(n / t * log2(n / t)), 9) AS entropy FROM c, (SELECT sum(n) AS t FROM c)".lstrip())
def _(spark, d):
    return metrics.entropy(preds(spark, d), "pred").select(F.round("entropy", 9).alias("entropy"))


SQL["A21_entropy"] = PREDS.rstrip() + ", c AS (SELECT pred, count(*) AS n FROM v_preds GROUP BY pred) SELECT round(-sum(n / t * log2(n / t)), 9) AS entropy FROM c, (SELECT sum(n) AS t FROM c)"


@add("A22_rouge")
def _(spark, d):
    pairs = spark.read.parquet(f"{d}/conversations.parquet").groupBy("conv_id").agg(F.min("text").alias("truth"), F.max("text").alias("pred"))
    return metrics.rouge_scores(pairs, "truth", "pred")


@add("A23_positional_quantiles", METRICS + "SELECT s[1] AS min, s[CAST(len(s) // 4 AS INT) + 1] AS p25, s[CAST(len(s) // 2 AS INT) + 1] AS median, s[CAST(3 * len(s) // 4 AS INT) + 1] AS p75, s[len(s)] AS max, len(s) AS n FROM (SELECT list_sort(list(metric)) AS s FROM v_metrics WHERE metric IS NOT NULL)")
def _(spark, d):
    return metrics.positional_quantiles(view(spark, d, "v_metrics"), "metric")


@add("A24_action_distribution", FRAMES + "SELECT action_label, count(*) AS n, round_even(100.0 * count(*) / (SELECT count(*) FROM v_frames), 2) AS pct FROM v_frames GROUP BY 1")
def _(spark, d):
    return metrics.distribution(view(spark, d, "v_frames"), "action_label")


@add("A26_A27_episodes", FRAMES + "SELECT count(DISTINCT episode_id) AS episodes, round(sum(reward) / count(DISTINCT episode_id), 6) AS mean_reward, count(*) AS frames FROM v_frames")
def _(spark, d):
    f = view(spark, d, "v_frames")
    return f.agg(F.count_distinct("episode_id").alias("episodes"), F.round(F.sum("reward") / F.count_distinct("episode_id"), 6).alias("mean_reward"), F.count(F.lit(1)).alias("frames"))


@add("A28_W07_best_trial", "SELECT trial, round(avg(step_s), 9) AS mean_step_s, round(sum(tokens) / sum(step_s), 9) AS tokens_per_s, count(*) AS steps FROM (SELECT l_orderkey AS trial, l_quantity AS step_s, l_partkey AS tokens, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS k FROM lineitem) WHERE k > 2 GROUP BY trial")
def _(spark, d):
    steps = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("trial"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("step"), F.col("l_quantity").alias("step_s"), F.col("l_partkey").alias("tokens"))
    out = metrics.best_trial(steps)
    return out.select("trial", F.round("mean_step_s", 9).alias("mean_step_s"), F.round("tokens_per_s", 9).alias("tokens_per_s"), "steps")


@add("F42_F43_temperature_and_tier", PREDS + "SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-ln(q / (1 - q)) / 1.5)), 9) AS p, CASE WHEN confidence >= 0.9 THEN 'auto_alert' WHEN confidence >= 0.7 THEN 'needs_verification' WHEN confidence >= 0.4 THEN 'review_queue' ELSE 'log_only' END AS tier FROM (SELECT *, least(greatest(confidence, 1e-7), 1 - 1e-7) AS q FROM v_preds)")
def _(spark, d):
    c = F.col("confidence")
    return preds(spark, d).select("l_orderkey", "l_linenumber", F.round(metrics.temper(c, 1.5), 9).alias("p"), metrics.alert_tier(c).alias("tier"))


@add("F44_F45_softmax", "SELECT l_orderkey, l_linenumber, round(greatest(exp(l_tax), exp(l_discount)) / (exp(l_tax) + exp(l_discount)), 9) AS confidence FROM lineitem")
def _(spark, d):
    row = F.array("l_tax", "l_discount")
    return spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.round(metrics.sequence_confidence(F.array(row, row)), 9).alias("confidence"))


_Q = "least(greatest(1 / (1 + exp(-ln(least(greatest(confidence, 1e-7), 1 - 1e-7) / (1 - least(greatest(confidence, 1e-7), 1 - 1e-7))) / {t})), 1e-7), 1 - 1e-7)"
_LOSS = "avg(CASE WHEN truth = pred THEN -ln({q}) ELSE -ln(1 - {q}) END)"


@add("F46_F52_fit_temperature", PREDS + "SELECT arg_min(t, l) AS temperature, round(min(l), 6) AS loss FROM (" + " UNION ALL ".join(f"SELECT CAST({t} AS DOUBLE) AS t, {_LOSS.format(q=_Q.format(t=t))} AS l FROM v_preds" for t in (0.5, 1.0, 2.0, 4.0, 8.0)) + ")")
def _(spark, d):
    return metrics.fit_temperature(preds(spark, d), "confidence", _right(), [0.5, 1.0, 2.0, 4.0, 8.0]).select("temperature", F.round("loss", 6).alias("loss"))


@add("W04_T14_rolling", METRICS + "SELECT run_id, seq, round(m + 1e-9, 6) AS mean_last, x AS max_last, round(max(CASE WHEN k >= 10 THEN m END) OVER (PARTITION BY run_id ORDER BY seq) + 1e-9, 6) AS best_mean FROM (SELECT run_id, seq, avg(metric) OVER w AS m, max(metric) OVER w AS x, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS k FROM v_metrics WINDOW w AS (PARTITION BY run_id ORDER BY seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))")
def _(spark, d):
    out = metrics.rolling(view(spark, d, "v_metrics"), "run_id", "seq", "metric")
    return out.select("run_id", "seq", F.round(F.col("mean_last") + 1e-9, 6).alias("mean_last"), "max_last", F.round(F.col("best_mean") + 1e-9, 6).alias("best_mean"))


@add("W05_T13_throughput", METRICS + "SELECT run_id, seq, round(CASE WHEN s > 0 THEN (n - 1) / s END, 9) AS steps_per_s FROM (SELECT run_id, seq, seq - first_value(seq) OVER w AS s, count(*) OVER w AS n FROM v_metrics WINDOW w AS (PARTITION BY run_id ORDER BY seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))")
def _(spark, d):
    out = metrics.throughput(view(spark, d, "v_metrics"), "run_id", "seq", "seq", 1000)
    return out.select("run_id", "seq", F.round("steps_per_s", 9).alias("steps_per_s"))


def events(spark, d):
    """Metric events of the driver's table: signups begin a run, errors end it, the rest are metrics."""
    kind = F.when(F.col("event_type") == "signup", "train_begin").when(F.col("event_type") == "error", "train_end").otherwise("metrics")
    return spark.read.parquet(f"{d}/events.parquet").select(F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("seq"), kind.alias("event"), F.col("ts").cast("timestamp").alias("ts"), F.lit(0).alias("step"), F.col("value").alias("metric"))


_EV = "WITH v AS (SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS seq, CASE event_type WHEN 'signup' THEN 'train_begin' WHEN 'error' THEN 'train_end' ELSE 'metrics' END AS event, ts, value AS metric FROM events) "
_STATE = _EV.rstrip() + ", s AS (SELECT run_id, max(seq) FILTER (WHERE event = 'train_begin') AS b, max(seq) FILTER (WHERE event = 'train_end') AS e, min(seq) FILTER (WHERE event = 'metrics') AS m, arg_max(metric, seq) FILTER (WHERE event = 'metrics') AS latest_metric, max(seq) FILTER (WHERE event = 'metrics') AS latest_seq, count(*) AS events FROM v GROUP BY run_id) SELECT run_id, CASE WHEN e IS NOT NULL AND coalesce(b, -1) < e THEN 'complete' WHEN coalesce(b, m) IS NOT NULL THEN 'training' ELSE 'waiting' END AS status, coalesce(b, m) AS start_seq, latest_metric, latest_seq, events FROM s"


@add("T01_T07_T20_run_state", _STATE)
def _(spark, d):
    return live.run_state(events(spark, d))


def streamed(spark, d, parts: int = 3):
    """The events as a file stream of a few micro-batches, for small tables."""
    folder = new_folder(spark)
    for i in range(parts):
        events(spark, d).where(F.col("seq") % parts == i).coalesce(1).write.mode("append").json(f"{folder}/in")
    return live.read_events(spark, f"{folder}/in", per_trigger=1), folder


@add("T01_run_state_streamed", _STATE)
def _(spark, d):
    stream, folder = streamed(spark, d)
    return live.run_available(live.run_state(stream), "t01_run_state", "complete", f"{folder}/ck")


@add("T02_T08_ring", _EV + "SELECT seq, event FROM v ORDER BY seq DESC LIMIT 5000")
def _(spark, d):
    return live.ring(events(spark, d), 5000).select("seq", "event")


@add("T05_T09_bench_state", _EV.replace("'signup' THEN 'train_begin'", "'signup' THEN 'bench_start'").replace("'error' THEN 'train_end'", "'error' THEN 'trial_end'").replace("ELSE 'metrics'", "WHEN 'purchase' THEN 'trial_start' ELSE 'bench_step'").rstrip() + ", l AS (SELECT run_id, coalesce(max(seq) FILTER (WHERE event = 'bench_start'), -1) AS since FROM v GROUP BY 1), r AS (SELECT v.* FROM v JOIN l USING (run_id) WHERE seq >= since) SELECT run_id, CASE WHEN max(seq) FILTER (WHERE event = 'bench_start') IS NOT NULL THEN 'running' ELSE 'idle' END AS status, count(*) FILTER (WHERE event = 'trial_end') AS results, count(*) FILTER (WHERE event = 'bench_step') AS steps, CASE WHEN coalesce(max(seq) FILTER (WHERE event = 'trial_start'), -1) > coalesce(max(seq) FILTER (WHERE event = 'trial_end'), -1) THEN arg_max(metric, seq) FILTER (WHERE event = 'trial_start') END AS current_trial FROM r GROUP BY run_id")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    kind = F.when(F.col("event_type") == "signup", "bench_start").when(F.col("event_type") == "error", "trial_end").when(F.col("event_type") == "purchase", "trial_start").otherwise("bench_step")
    return live.bench_state(e.select(F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("seq"), kind.alias("event"), F.col("value").alias("metric")))


@add("T12_throttled", _EV + "SELECT run_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS slot, min(seq) AS seq, arg_min(event, seq) AS event, arg_min(metric, seq) AS metric FROM v GROUP BY 1, 2")
def _(spark, d):
    return live.throttled(events(spark, d), 3600)


@add("T15_T16_over_limit", _EV + "SELECT seq FROM v WHERE metric >= 100")
def _(spark, d):
    return live.over_limit(events(spark, d), "metric", 100).select("seq")


@add("T_windowed_counts", _EV + "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event, count(*) AS n, round(avg(metric), 6) AS mean FROM v GROUP BY 1, 2")
def _(spark, d):
    out = live.windowed(events(spark, d), "1 hour")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event", "n", F.round("mean", 6).alias("mean"))


@add("S01_jsonl_conversations", "SELECT conv_id, coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS user_message, coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '') AS assistant_message FROM conversations GROUP BY conv_id HAVING coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') <> '' AND coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '') <> ''")
def _(spark, d):
    turns = spark.read.parquet(f"{d}/conversations.parquet").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("m"))
    line = F.when(F.col("conv_id") % 2 == 0, F.to_json(F.struct(F.col("m").alias("messages")))).otherwise(F.to_json("m"))
    return conversations.pairs(turns.select("conv_id", conversations.messages_of_json(line).alias("messages"))).select("conv_id", "user_message", "assistant_message")


@add("S02_P12_P13_chat_text", "SELECT conv_id, md5(CASE WHEN bool_or(role = 'system') THEN '' ELSE '<|system|>' || chr(10) || 'Help.</s>' || chr(10) END || string_agg('<|' || role || '|>' || chr(10) || text || '</s>' || chr(10), '' ORDER BY turn)) AS h FROM conversations WHERE role IS NOT NULL AND text IS NOT NULL GROUP BY conv_id")
def _(spark, d):
    turns = spark.read.parquet(f"{d}/conversations.parquet").dropna(subset=["role", "text"]).groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("m"))
    return turns.select("conv_id", F.md5(conversations.render(conversations.with_system(F.col("m"), "Help.")).cast("binary")).alias("h"))
