"""Evaluation metrics and calibration over predictions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def classification(preds: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """Per class: tp, fp, fn, precision, recall, f1, support. A missing prediction only counts against the true class."""
    t, p = F.col(truth), F.col(pred)
    hits = preds.where(t.isNotNull()).select(F.explode(F.array(F.struct(t.alias("label"), (t == p).cast("int").alias("tp"), F.lit(0).alias("fp"), F.coalesce((t != p).cast("int"), F.lit(1)).alias("fn"), F.lit(1).alias("s")), F.struct(p.alias("label"), F.lit(0).alias("tp"), (t != p).cast("int").alias("fp"), F.lit(0).alias("fn"), F.lit(0).alias("s")))).alias("x")).select("x.*")
    sums = hits.where("label IS NOT NULL").groupBy("label").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")), F.sum("s").alias("support"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    out = sums.withColumns({"precision": F.coalesce(precision, F.lit(0.0)), "recall": F.coalesce(recall, F.lit(0.0))})
    both = F.col("precision") + F.col("recall")
    return out.withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0))


def macro(per_class: DataFrame) -> DataFrame:
    return per_class.agg(F.avg("f1").alias("macro_f1"), F.count(F.lit(1)).alias("classes"))


def accuracy(preds: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    right = F.count_if(F.lower(truth) == F.lower(pred))
    return preds.agg(F.count(F.lit(1)).alias("n"), right.alias("right"), (right / F.count(F.lit(1))).alias("accuracy"))


def reliability_bins(preds: DataFrame, confidence: str, correct: Column, bins: int = 10, closed: bool = False) -> DataFrame:
    """bin, n, avg_conf, avg_acc over equal bins of [0, 1); closed takes 1.0 into the last bin."""
    c = F.col(confidence)
    at = F.floor(c * bins).cast("int")
    if closed:
        at = F.least(at, F.lit(bins - 1))
    rows = preds.select(c.alias("c"), correct.cast("double").alias("y"), at.alias("bin"))
    return rows.where((F.col("bin") >= 0) & (F.col("bin") < bins)).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("c").alias("avg_conf"), F.avg("y").alias("avg_acc"))


def ece(preds: DataFrame, confidence: str, correct: Column, bins: int = 10, closed: bool = False) -> DataFrame:
    """Expected calibration error; rows in no bin stay in the denominator."""
    total = preds.agg(F.count(F.lit(1)).alias("total"))
    b = reliability_bins(preds, confidence, correct, bins, closed)
    gap = F.coalesce(F.sum(F.col("n") * F.abs(F.col("avg_acc") - F.col("avg_conf"))), F.lit(0.0))
    return b.agg(gap.alias("g")).crossJoin(total).select((F.col("g") / F.col("total")).alias("ece"), "total")


def temper(p: Column, temperature: float) -> Column:
    """A probability at another temperature, 0.01 at least."""
    q = F.least(F.greatest(p, F.lit(1e-7)), F.lit(1 - 1e-7))
    return 1 / (1 + F.exp(-F.ln(q / (1 - q)) / max(temperature, 0.01)))


def alert_tier(p: Column) -> Column:
    return F.when(p >= 0.90, "auto_alert").when(p >= 0.70, "needs_verification").when(p >= 0.40, "review_queue").otherwise("log_only")


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp((x - top) / temperature))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def sequence_confidence(logits: Column) -> Column:
    """The mean over tokens of the largest probability."""
    best = F.transform(logits, lambda row: F.array_max(softmax(row)))
    return F.aggregate(best, F.lit(0.0), lambda a, x: a + x) / F.size(best)


def cross_entropy(preds: DataFrame, confidence: str, correct: Column, temperature: float) -> DataFrame:
    p = F.least(F.greatest(temper(F.col(confidence), temperature), F.lit(1e-7)), F.lit(1 - 1e-7))
    y = correct.cast("double")
    return preds.agg(F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("loss"))


def fit_temperature(preds: DataFrame, confidence: str, correct: Column, grid: list[float]) -> DataFrame:
    """temperature and loss, the least over a grid, in one pass over the rows."""
    y = correct.cast("double")

    def loss(t: float) -> Column:
        p = F.least(F.greatest(temper(F.col(confidence), t), F.lit(1e-7)), F.lit(1 - 1e-7))
        return F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p)))

    one = preds.agg(*(loss(t).alias(f"t{i}") for i, t in enumerate(grid)))
    every = F.array(*(F.struct(F.col(f"t{i}").alias("loss"), F.lit(float(t)).alias("temperature")) for i, t in enumerate(grid)))
    return one.select(F.array_min(every).alias("b")).select("b.temperature", "b.loss")


def confusion(preds: DataFrame, truth: str, pred: str, labels: list[str]) -> DataFrame:
    return preds.groupBy(truth).pivot(pred, labels).count().fillna(0)


def entropy(df: DataFrame, label: str) -> DataFrame:
    """Shannon entropy in bits of a label's distribution."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    p = F.col("n") / F.col("t")
    return counts.crossJoin(F.broadcast(total)).agg((-F.sum(p * F.log2(p))).alias("entropy"))


def distribution(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    return counts.crossJoin(F.broadcast(total)).select(label, "n", F.bround(100 * F.col("n") / F.col("t"), 2).alias("pct"))


def positional_quantiles(df: DataFrame, value: str, parts: int = 4) -> DataFrame:
    """min, the sorted values at places n // 4, n // 2 and 3 n // 4, and max, without gathering the values.

    Counts of each value and their running sum give the places.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    edges = counts.withColumn("hi", F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    total = counts.agg(F.sum("n").alias("t"))
    at = lambda k: F.min(F.when(F.col("hi") > F.floor(F.col("t") * k / parts), F.col("v")))
    return edges.crossJoin(F.broadcast(total)).agg(F.min("v").alias("min"), at(1).alias("p25"), at(2).alias("median"), at(3).alias("p75"), F.max("v").alias("max"), F.first("t").alias("n"))


def rouge(truth: str, pred: str) -> dict[str, float]:
    """ROUGE-1, -2 and -L F-measures of one pair over lower-case words of letters and digits."""
    import re
    from collections import Counter

    a, b = re.findall(r"[a-z0-9]+", truth.lower()), re.findall(r"[a-z0-9]+", pred.lower())

    def f(hits: int, n: int, m: int) -> float:
        return 2 * hits / (n + m) if hits else 0.0

    out = {}
    for k in (1, 2):
        x, y = (Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for w in (a, b))
        out[f"rouge{k}"] = f(sum((x & y).values()), sum(x.values()), sum(y.values()))
    row = [0] * (len(b) + 1)
    for w in a:
        last = 0
        for j, v in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if w == v else max(row[j + 1], row[j])
    out["rougeL"] = f(row[-1], len(a), len(b))
    return out


def rouge_scores(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Mean ROUGE, the share of exact matches and the number of empty predictions; scores come Arrow batch by batch."""
    import pandas as pd

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [rouge(t or "", p or "") for t, p in zip(pdf[truth], pdf[pred])]
            yield pd.DataFrame(rows, columns=["rouge1", "rouge2", "rougeL"]).assign(exact=[(t or "").strip() == (p or "").strip() for t, p in zip(pdf[truth], pdf[pred])], empty=[not (p or "").strip() for p in pdf[pred]])

    rows = df.select(truth, pred).mapInPandas(score, "rouge1 double, rouge2 double, rougeL double, exact boolean, empty boolean")
    return rows.agg(*(F.avg(c).alias(c) for c in ("rouge1", "rouge2", "rougeL")), F.avg(F.col("exact").cast("double")).alias("exact_match"), F.count_if("empty").alias("empty_count"))


def evaluate(df: DataFrame, predict: Callable[[list[str]], list[str | None]], prompt: str = "prompt", out: str = "answer") -> DataFrame:
    """df with the answers of a caller's model, asked batch by batch."""
    import pandas as pd
    from pyspark.sql import types as T

    schema = T.StructType([*(f for f in df.schema.fields if f.name != out), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{out: predict(list(pdf[prompt]))})[[f.name for f in schema.fields]]

    return df.mapInPandas(run, schema)


def rolling(df: DataFrame, run: str, order: str, value: str, last: int = 100, least: int = 10) -> DataFrame:
    """df with the mean and maximum of the last values, and the best mean so far among those of at least least values."""
    w = Window.partitionBy(run).orderBy(order)
    near = w.rowsBetween(-(last - 1), 0)
    out = df.withColumns({"mean_last": F.avg(value).over(near), "max_last": F.max(value).over(near), "__n": F.row_number().over(w)})
    return out.withColumn("best_mean", F.max(F.when(F.col("__n") >= least, F.col("mean_last"))).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__n")


def throughput(df: DataFrame, run: str, order: str, seconds: str, total_steps: int, last: int = 100) -> DataFrame:
    """df with steps per second over the last steps and the seconds left."""
    w = Window.partitionBy(run).orderBy(order)
    near = w.rowsBetween(-(last - 1), 0)
    span = F.col(seconds) - F.first(seconds).over(near)
    rate = F.when(span > 0, (F.count(F.lit(1)).over(near) - 1) / span)
    step = F.row_number().over(w)
    return df.withColumns({"steps_per_s": rate, "eta_s": (F.lit(total_steps) - step) / rate})


def best_trial(steps: DataFrame, warm_up: int = 2) -> DataFrame:
    """Per trial the mean step time and tokens per second without the first steps."""
    w = Window.partitionBy("trial").orderBy("step")
    rows = steps.withColumn("__n", F.row_number().over(w)).where(F.col("__n") > warm_up)
    return rows.groupBy("trial").agg(F.avg("step_s").alias("mean_step_s"), (F.sum("tokens") / F.sum("step_s")).alias("tokens_per_s"), F.count(F.lit(1)).alias("steps"))


def rounded_once(values: Column) -> Column:
    """The mean of an array of doubles, rounded once: equal for equal values in any order. NaN where it is not finite, or near the largest double."""

    def add(a: Column, x: Column) -> Column:
        s = a["s"] + x
        t = s - a["s"]
        return F.struct(s.alias("s"), (a["c"] + ((a["s"] - (s - t)) + (x - t))).alias("c"))

    def divide(a: Column) -> Column:
        n = F.nullif(F.size(values), F.lit(0)).cast("double")
        q = a["s"] / n
        high = q * 134217729.0 - (q * 134217729.0 - q)
        return q + (((a["s"] - high * n) - (q - high) * n) + a["c"]) / n

    return F.aggregate(F.sort_array(values), F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c")), add, divide)


def checkpoints(df: DataFrame, run: str, order: str, value: str, every: int, last: int = 100, least: int = 10) -> DataFrame:
    """The events at which a model is kept: each every-th one whose rolling mean beats those of all kept before. Equal means are ties, however their values are ordered."""
    w, v = Window.partitionBy(run).orderBy(order), F.col(value).cast("double")
    near, before = w.rowsBetween(-(last - 1), 0), w.rowsBetween(Window.unboundedPreceding, -1)
    rolled = rolling(df, run, order, value, last, least).withColumns({"__k": F.row_number().over(w), "mean_last": F.avg(v).over(near), "__size": F.avg(F.abs(v)).over(near)})
    looked = (F.col("__k") % every == 0) & (F.col("__k") >= least)
    # Plain means are at most slip off: what stays below an earlier one by more than both slips is not summed again.
    slip = (last + 1) * 2.0**-52 * F.col("__size") + 1e-323
    beaten = F.max(F.when(looked, F.col("mean_last") - slip)).over(before)
    open_ = rolled.withColumn("__beaten", beaten).withColumn("__open", looked & (F.col("__beaten").isNull() | (F.col("mean_last") + slip >= F.col("__beaten"))))
    means = open_.withColumn("__near", F.collect_list(v).over(near)).where("__open").withColumn("mean_last", F.nanvl(rounded_once(F.col("__near")), F.col("mean_last"))).drop("__near")
    better = means.withColumn("__best", F.max("mean_last").over(before)).where(F.col("__best").isNull() | (F.col("mean_last") > F.col("__best")))
    return better.drop("__best", "__k", "__size", "__beaten", "__open")


def first_rows(df: DataFrame, group: str, order: list, most: int) -> DataFrame:
    """Rows of each group in their order until most are emitted."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most).drop("__n")
