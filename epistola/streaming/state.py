"""The state machines over a stream of requests, with their state in Spark's state store.

A machine's state is a few numbers for each key. Rows of a key are taken in order of (ts, event_id) within a batch, and batches in the
order of their arrival; a row that arrives in a later batch than one with a later time is taken after it. To be sorted, a key's rows of one batch
are held in memory, so a source is to be read with maxFilesPerTrigger or maxBytesPerTrigger, which bound a batch.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.state import Breaker, Delay, Retries

def _machine(requests: DataFrame, key: str, make, step, added: str, state: str) -> DataFrame:
    """(key, event_id, and what step(machine, row) gives), key a long."""
    names = [x.split()[0] for x in added.split(", ")]

    def run(k, frames, held: GroupState):
        machine = make(tuple(held.get) if held.exists else None)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        out = [step(machine, r) for r in rows.itertuples(index=False)]
        held.update(machine.state())
        yield pd.concat([pd.DataFrame({key: k[0], "event_id": rows["event_id"].to_numpy()}), pd.DataFrame(out, columns=names)], axis=1)

    return requests.groupBy(key).applyInPandasWithState(run, f"{key} long, event_id long, {added}", state, "append", GroupStateTimeout.NoTimeout)


def delays(requests: DataFrame) -> DataFrame:
    """The delay in force at each request (provider, event_id, ts in seconds, outcome) and after it."""

    def step(m, r):
        used = m.step(r.outcome)
        return r.outcome, used, m.delay

    return _machine(requests, "provider", lambda s: Delay(state=s), step, "outcome string, delay_used double, delay double", "delay double, errors int, calm int")


def breakers(requests: DataFrame) -> DataFrame:
    """The breaker's state at each request (provider, event_id, ts in seconds, ok)."""
    return _machine(requests, "provider", Breaker, lambda m, r: (bool(r.ok), m.step(float(r.ts), bool(r.ok))), "ok boolean, state string", "failures int, until double")


def retries(requests: DataFrame) -> DataFrame:
    """What becomes of each message at each attempt (message, event_id, ts, ok): done, retry or dead."""
    return _machine(requests, "message", Retries, lambda m, r: (m.step(bool(r.ok)), m.attempts), "state string, attempts int", "attempts int, dead boolean")


def run_once(stream: DataFrame, into: str, checkpoint: str) -> DataFrame:
    """Runs a stream over all that is there, exactly once, into Parquet files, and reads them."""
    query = stream.writeStream.format("parquet").option("path", into).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    spark: SparkSession = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(into)
