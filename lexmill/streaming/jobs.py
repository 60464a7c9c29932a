"""The durable job queue: leases, fencing, failure classes, as a batch fold and as stateful streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import backoff

#: Lease, steps in order.
LEASE_MINUTES = 30
STEPS = ["recu", "parse", "structure", "termine"]


def eligible(jobs: DataFrame, now: Column, lease: int = LEASE_MINUTES) -> DataFrame:
    """Jobs that may be reserved: pending, or running on an expired lease; oldest first in ``turn``."""
    free = (F.col("status") == "pending") | ((F.col("status") == "running") & (F.col("locked_at") < now - F.expr(f"interval {lease} minutes")))
    return jobs.where(free).withColumn("turn", F.row_number().over(Window.partitionBy("kind").orderBy("created_at", "id")))


def reserve(jobs: DataFrame, now: Column, worker: str, lease: int = LEASE_MINUTES) -> DataFrame:
    """The jobs as they are after the oldest eligible job of each kind was reserved."""
    taken = eligible(jobs, now, lease).where("turn = 1").select("id", F.lit(True).alias("__t"))
    out = jobs.join(taken, "id", "left")
    t = F.coalesce("__t", F.lit(False))
    put = {"status": F.lit("running"), "locked_at": now, "locked_by": F.lit(worker), "fencing_token": F.col("fencing_token") + 1, "attempts": F.col("attempts") + 1}
    return out.select(*[F.when(t, put[c]).otherwise(F.col(c)).alias(c) if c in put else F.col(c) for c in jobs.columns])


def failed(status_class: Column, attempts: Column, most: Column) -> Column:
    """Status after a failure: pending again while it may pass, else failed."""
    return F.when((status_class == "transitoire") & (attempts < most), "pending").otherwise("failed")


def retry_at(at: Column, attempts: Column) -> Column:
    return at + F.make_dt_interval(secs=backoff(attempts))


def next_step(step: Column) -> Column:
    out = F.lit(STEPS[-1])
    for a, b in zip(STEPS, STEPS[1:], strict=False):
        out = F.when(step == a, b).otherwise(out)
    return out


def fenced(events: DataFrame, key: str, order: str, token: str = "token") -> DataFrame:
    """Events with ``accepted``: false for a token below the greatest that came before."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    top = F.max(token).over(w)
    return events.withColumn("accepted", F.coalesce(F.col(token) >= top, F.lit(True)))


def fold(events: DataFrame, key: str, order: str) -> DataFrame:
    """State of each job after its accepted events (event_kind, token): status, attempts, last token, events and rejects."""
    rows = fenced(events, key, order)
    status = F.when(F.col("event_kind") == "reserve", "running").when(F.col("event_kind") == "done", "done").when(F.col("event_kind") == "fail", "failed").otherwise("pending")
    ok = F.col("accepted")
    return rows.groupBy(key).agg(
        F.max_by(F.when(ok, status), F.when(ok, F.col(order))).alias("status"),
        F.sum((ok & (F.col("event_kind") == "reserve")).cast("int")).alias("attempts"),
        F.max(F.when(ok, F.col("token"))).alias("token"),
        F.count("*").alias("n_events"),
        F.sum((~ok).cast("int")).alias("n_rejected"),
    )


def enqueue(entries: DataFrame, jobs: DataFrame) -> DataFrame:
    """Entries (id, statut, sha256) to queue: waiting ones without an open job, unless their last job failed for good on
    the same content."""
    wait = entries.where(F.col("statut").isin("telecharge", "erreur"))
    wait = wait.join(jobs.where("status in ('pending', 'running')").select(F.col("manifest_id").alias("id")), "id", "left_anti")
    last = jobs.groupBy(F.col("manifest_id").alias("id")).agg(F.max_by(F.struct("status", "error_class", F.col("sha256").alias("sha")), "created_at").alias("last"))
    out = wait.join(last, "id", "left")
    dead = (F.col("last.status") == "failed") & (F.col("last.error_class") == "definitive") & (F.col("last.sha") == F.col("sha256"))
    return out.where(~F.coalesce(dead, F.lit(False))).drop("last")


def relaunch(jobs: DataFrame, wanted: Column) -> DataFrame:
    """Only failed jobs go back to the queue, attempts at 0."""
    go = wanted & (F.col("status") == "failed")
    return jobs.withColumns({"attempts": F.when(go, 0).otherwise(F.col("attempts")), "status": F.when(go, "pending").otherwise(F.col("status"))})


def rollup(has_md: Column, has_json: Column) -> Column:
    return F.when(has_md & has_json, "completed").when(has_md | has_json, "partial").otherwise("pending")


_STATE = "status string, attempts int, token long"
_OUT = "job_id long, status string, attempts int, token long, n_events long, n_rejected long"


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """One job's new events against its state; an event with an older token is rejected."""
    status, attempts, token = state.get if state.exists else ("pending", 0, -1)
    n = rejected = 0
    for frame in frames:
        for e in frame.sort_values("seq").itertuples():
            n += 1
            if e.token < token:
                rejected += 1
                continue
            token = int(e.token)
            status = {"reserve": "running", "done": "done", "fail": "failed"}.get(e.event_kind, "pending")
            attempts += e.event_kind == "reserve"
    state.update((status, attempts, token))
    yield pd.DataFrame({"job_id": [key[0]], "status": [status], "attempts": [attempts], "token": [token], "n_events": [n], "n_rejected": [rejected]})


def stream_states(events: DataFrame) -> DataFrame:
    """Streaming form of ``fold``: events (job_id, seq, event_kind, token) -> a row for each job whenever it has news."""
    return events.groupBy("job_id").applyInPandasWithState(_advance, _OUT, _STATE, "update", "NoTimeout")
