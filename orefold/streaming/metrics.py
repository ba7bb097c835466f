"""Live metric state. Each transformation of a stream equals its batch form on the same events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Columns of metric events; fields that an event does not have are null.
EVENTS = "run_id STRING, seq BIGINT, event STRING, ts TIMESTAMP, step INT, metric DOUBLE"


def read_events(spark: SparkSession, path: str, schema: str = EVENTS, per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.json(path)


def _status(kind: Column) -> Column:
    return F.when(kind == "train_end", "complete").when(kind.isin("train_begin", "metrics"), "training")


def run_state(events: DataFrame, begin: str = "train_begin", metric: str = "metrics", end: str = "train_end") -> DataFrame:
    """Per run: status, start_seq, and the latest metric with its sequence.

    A run whose begin was missed starts with its first metric; metrics behind an
    end leave it complete, a new begin opens it again.
    """
    kind, seq = F.col("event"), F.col("seq")
    at = lambda name: F.max(F.when(kind == name, seq))
    out = events.groupBy("run_id").agg(
        at(begin).alias("b"), at(end).alias("e"), F.min(F.when(kind == metric, seq)).alias("m"), F.max_by(F.when(kind == metric, F.col("metric")), F.when(kind == metric, seq)).alias("latest_metric"), at(metric).alias("latest_seq"), F.count(F.lit(1)).alias("events")
    )
    open_ = F.coalesce("b", "m").isNotNull()
    status = F.when(F.col("e").isNotNull() & (F.coalesce("b", F.lit(-1)) < F.col("e")), "complete").when(open_, "training").otherwise("waiting")
    return out.select("run_id", status.alias("status"), F.coalesce("b", "m").alias("start_seq"), "latest_metric", "latest_seq", "events")


def bench_state(events: DataFrame) -> DataFrame:
    """Per bench run: status, results since the last start and the trial under way."""
    kind, seq = F.col("event"), F.col("seq")
    last = events.groupBy("run_id").agg(F.coalesce(F.max(F.when(kind == "bench_start", seq)), F.lit(-1)).alias("since"))
    rows = events.join(last, "run_id").where("seq >= since")
    closes = kind.isin("trial_end", "trial_skip")
    return rows.groupBy("run_id").agg(
        F.when(F.max(F.when(kind == "bench_end", seq)).isNotNull(), "complete").when(F.max(F.when(kind == "bench_start", seq)).isNotNull(), "running").otherwise("idle").alias("status"),
        F.count_if(closes).alias("results"),
        F.count_if(kind == "bench_step").alias("steps"),
        F.when(F.coalesce(F.max(F.when(kind == "trial_start", seq)), F.lit(-1)) > F.coalesce(F.max(F.when(closes, seq)), F.lit(-1)), F.max_by("metric", F.when(kind == "trial_start", seq))).alias("current_trial"),
    )


def ring(events: DataFrame, size: int = 10_000) -> DataFrame:
    """The last events by sequence, without an order over all of them in one task."""
    return events.orderBy(F.desc("seq")).limit(size)


def keep_ring(spark: SparkSession, folder: str, size: int = 10_000) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: the last events so far, in a new folder for each batch; repeated batches write the same."""

    def write(batch: DataFrame, number: int) -> None:
        old = spark.read.schema(batch.schema).parquet(f"{folder}/batch={number - 1}") if number else batch.limit(0)
        ring(old.unionByName(batch).dropDuplicates(["seq"]), size).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def fan_out(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: one batch to several sinks; a failing sink does not stop the others."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        failed = []
        for sink in sinks:
            try:
                sink(batch, number)
            except Exception as e:  # reported when all sinks had their turn
                failed.append(e)
        batch.unpersist()
        if failed:
            raise RuntimeError(f"{len(failed)} of {len(sinks)} sinks failed") from failed[0]

    return write


def over_limit(events: DataFrame, value: str, limit: float) -> DataFrame:
    """Events at or beyond a limit of time or memory."""
    return events.where(F.col(value) >= limit)


def throttled(events: DataFrame, seconds: float = 2.0) -> DataFrame:
    """The first event of each run and time slot: at most one in so many seconds."""
    slot = F.floor(F.col("ts").cast("double") / seconds)
    return events.groupBy("run_id", slot.alias("slot")).agg(F.min_by(F.struct("seq", "event", "metric"), "seq").alias("e")).select("run_id", "slot", "e.*")


ROLLING = "run_id STRING, seq BIGINT, mean_last DOUBLE, max_last DOUBLE, best_mean DOUBLE"


def rolling_stream(events: DataFrame, last: int = 100, least: int = 10) -> DataFrame:
    """Mean and maximum of the last values of a run and its best mean so far, per event, with bounded state for each run."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        values, best, seen = state.get if state.exists else ([], None, 0)
        values = list(values)
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for seq, value in zip(rows["seq"], rows["metric"]):
            values = (values + [float(value)])[-last:]
            seen += 1
            mean = sum(values) / len(values)
            if seen >= least:
                best = mean if best is None else max(best, mean)
            out.append((key[0], int(seq), mean, max(values), best))
        state.update((values, best, seen))
        yield pd.DataFrame(out, columns=["run_id", "seq", "mean_last", "max_last", "best_mean"])

    return events.groupBy("run_id").applyInPandasWithState(step, ROLLING, "values ARRAY<DOUBLE>, best DOUBLE, seen BIGINT", "append", GroupStateTimeout.NoTimeout)


def rolling_batch(events: DataFrame, last: int = 100, least: int = 10) -> DataFrame:
    from orefold.operators.metrics import rolling

    return rolling(events, "run_id", "seq", "metric", last, least).select("run_id", "seq", "mean_last", "max_last", "best_mean")


def windowed(events: DataFrame, width: str = "10 minutes", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts and means by event time, tumbling or sliding; an addition beyond arrival order."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    source = events.withWatermark("ts", late) if events.isStreaming else events
    return source.groupBy(w.alias("w"), "event").agg(F.count(F.lit(1)).alias("n"), F.avg("metric").alias("mean")).select(F.col("w.start").alias("start"), "event", "n", "mean")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    source = events.withWatermark("ts", late) if events.isStreaming else events
    return source.groupBy(F.session_window("ts", gap).alias("w"), "run_id").agg(F.count(F.lit(1)).alias("n")).select("run_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def run_available(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Everything that a stream has now, through a memory table."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def step_event(step: Column, seconds: Column, tokens: Column, memory: Column | None = None) -> Column:
    """A bench step with its tokens a second and, where sampled, the memory in use."""
    rate = F.when(seconds > 0, tokens / seconds)
    return F.struct(F.lit("bench_step").alias("event"), step.alias("step"), rate.alias("tokens_per_s"), (memory if memory is not None else F.lit(None).cast("double")).alias("memory_gb"))


def evaluation_event(step: Column, loss: Column) -> Column:
    return F.struct(F.lit("eval").alias("event"), step.alias("step"), loss.alias("eval_loss"))


def lifecycle(events: DataFrame, begin: str = "train_begin", end: str = "train_end") -> DataFrame:
    """Begin and end of each run with the seconds between them; runs still open have none."""
    at = lambda name, f: f(F.when(F.col("event") == name, F.col("ts")))
    out = events.groupBy("run_id").agg(at(begin, F.min).alias("began"), at(end, F.max).alias("ended"))
    return out.where("began IS NOT NULL").select("run_id", F.when(F.col("ended") >= F.col("began"), F.col("ended").cast("double") - F.col("began").cast("double")).alias("elapsed"))


def process_state(lines: DataFrame) -> DataFrame:
    """Status, first and last time and number of lines of each job of a log (job, seq, ts, line, code); code is that of its exit."""
    code = F.max_by(F.when(F.col("code").isNotNull(), F.col("code")), F.when(F.col("code").isNotNull(), F.col("seq")))
    out = lines.groupBy("job").agg(code.alias("code"), F.min("ts").alias("began"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("lines"))
    return out.withColumn("status", F.when(F.col("code").isNull(), "running").when(F.col("code") == 0, "finished").otherwise("failed"))


def replay_then_tail(history: DataFrame, stream: DataFrame, deliver: Callable[[DataFrame, int], None], checkpoint: str, done: str | None = None, keep_alive: Callable[[int], None] | None = None, idle_s: float = 30.0) -> int:
    """Delivers what was stored and then each batch of the stream, from the offset that checkpoint holds; the last batch number.

    A subscriber that comes again with its checkpoint gets no replay and only
    what is new.  Ends where a batch has a row for which done holds, or, without
    done, when the stream has nothing more.  Where nothing came for idle_s, keep_alive
    is called.  Failures of deliver stop this subscriber alone.
    """
    import time

    state = {"batch": -1, "done": False, "last": time.monotonic()}

    def write(batch: DataFrame, number: int) -> None:
        if state["done"]:
            return
        batch.persist()
        deliver(batch, number)
        state.update(batch=number, last=time.monotonic())
        state["done"] = done is not None and not batch.where(done).isEmpty()
        batch.unpersist()

    from orefold.sources.landing import exists

    if not exists(stream.sparkSession, f"{checkpoint}/offsets"):
        deliver(history, -1)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if done is None:
        writer.trigger(availableNow=True).start().awaitTermination()
        return state["batch"]
    query = writer.trigger(processingTime="1 second").start()
    while query.isActive and not state["done"]:
        query.awaitTermination(1)
        if keep_alive is not None and time.monotonic() - state["last"] > idle_s:
            keep_alive(state["batch"])
            state["last"] = time.monotonic()
    if query.exception() is not None:
        raise query.exception()
    query.stop()
    return state["batch"]


def quietly(post: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: posts a batch and forgets it; a failing post is logged and ignored."""
    import logging

    def write(batch: DataFrame, number: int) -> None:
        try:
            post(batch, number)
        except Exception:
            logging.getLogger(__name__).warning("batch %d was not posted", number, exc_info=True)

    return write
