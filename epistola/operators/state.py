"""State machines replayed in order: adaptive delay, circuit breaker, retry queue.

The delay and the breaker depend on every step before, so a key's requests are read in order by one task; rows pass through in
batches with a few numbers of state, so a key of any length needs no memory. The retry queue has a closed form and is a window.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INITIAL, LOWEST, HIGHEST, CALM = 30.0, 10.0, 120.0, 5
TRIP, OPEN_SECONDS, ATTEMPTS = 3, 300, 3


class Delay:
    """The adaptive delay. Five successes in a row end at the initial delay, however low it was."""

    def __init__(self, initial=INITIAL, lowest=LOWEST, highest=HIGHEST, state=None):
        self.initial, self.lowest, self.highest = initial, lowest, highest
        self.delay, self.errors, self.calm = state or (initial, 0, 0)

    def step(self, outcome: str) -> float:
        """Takes in an outcome and returns the delay that was in force before it. An outcome that it doesn't know changes nothing."""
        used = self.delay
        if outcome == "success":
            self.errors, self.calm = 0, self.calm + 1
            self.delay = max(self.lowest, self.delay * 0.8)
            if self.calm >= CALM:
                self.delay, self.calm = self.initial, 0
        elif outcome in ("rate_limit_error", "other_error", "timeout"):
            self.errors, self.calm = self.errors + 1, 0
            if outcome == "rate_limit_error":
                self.delay = min(self.highest, self.delay * 1.5 ** min(self.errors, 3))
            elif self.errors >= 2:
                self.delay = min(self.highest, self.delay * 1.2)
        return used

    def state(self) -> tuple[float, int, int]:
        return self.delay, self.errors, self.calm


def wait(delay: float, elapsed: float | None) -> float:
    """Seconds to wait before the next request; none before the first."""
    return 0.0 if elapsed is None else max(0.0, delay - elapsed)


class Breaker:
    """Opens for five minutes after three failures in a row, and closes at the first look after that."""

    def __init__(self, state=None):
        self.failures, self.until = state or (0, None)

    def step(self, at: float, ok: bool) -> str:
        if self.until is not None:
            if at < self.until:
                return "open"
            self.until = None
        if ok:
            self.failures = 0
            return "closed"
        self.failures += 1
        if self.failures >= TRIP:
            self.failures, self.until = 0, at + OPEN_SECONDS
            return "tripped"
        return "closed"

    def state(self) -> tuple[int, float | None]:
        return self.failures, self.until


class Retries:
    """Attempts of one message: three failures without a success between end it for good."""

    def __init__(self, state=None):
        self.attempts, self.dead = state or (0, False)

    def step(self, ok: bool) -> str:
        if self.dead:
            return "dead"
        self.attempts = 0 if ok else self.attempts + 1
        self.dead = self.attempts >= ATTEMPTS
        return "dead" if self.dead else "done" if ok else "retry"

    def state(self) -> tuple[int, bool]:
        return self.attempts, self.dead


def _in_order(rows: DataFrame, key: str, schema: str, make, step) -> DataFrame:
    """Reads each key's rows in order of (ts, event_id) and adds what step(machine, row) gives."""

    def run(frames):
        held, machine = None, None
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                k = getattr(row, key)
                if machine is None or k != held:
                    held, machine = k, make()
                out.append(step(machine, row))
            yield pd.concat([frame.drop(columns=["ts"]), pd.DataFrame(out, index=frame.index)], axis=1)

    return rows.repartition(key).sortWithinPartitions(key, "ts", "event_id").mapInPandas(run, schema)


def delays(events: DataFrame, key: str = "provider") -> DataFrame:
    """(key, event_id, outcome, delay_used, delay) of requests (key, event_id, ts in seconds, outcome)."""

    def step(m, row):
        used = m.step(row.outcome)
        return {"delay_used": used, "delay": m.delay}

    return _in_order(events.select(key, "event_id", "ts", "outcome"), key, f"{key} long, event_id long, outcome string, delay_used double, delay double", Delay, step)


def breaker(events: DataFrame, key: str = "provider") -> DataFrame:
    """(key, event_id, ok, state) of requests (key, event_id, ts in seconds, ok); open requests are turned away and change nothing."""
    return _in_order(events.select(key, "event_id", "ts", "ok"), key, f"{key} long, event_id long, ok boolean, state string", Breaker, lambda m, row: {"state": m.step(float(row.ts), bool(row.ok))})


def retry_queue(events: DataFrame, key: str = "message") -> DataFrame:
    """(key, attempts, dead): a success clears the attempts; a message with three failures and no success between is dead for good."""
    w = Window.partitionBy(key).orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    parted = events.withColumn("part", F.sum(F.col("ok").cast("int")).over(w))
    runs = parted.groupBy(key, "part").agg(F.count_if(~F.col("ok")).alias("failures"))
    return runs.groupBy(key).agg(F.least(F.max_by("failures", "part"), F.lit(ATTEMPTS)).cast("long").alias("last"), (F.max("failures") >= ATTEMPTS).alias("dead")).select(key, F.when(F.col("dead"), F.lit(ATTEMPTS)).otherwise(F.col("last")).cast("long").alias("attempts"), "dead")


def next_provider(active: list[tuple[str, bool]], current: str, wrap: bool = False) -> str | None:
    """The next healthy provider after the current one in order; with wrap the first healthy one if there is none."""
    names = [n for n, _ in active]
    at = names.index(current) if current in names else -1
    for n, ok in active[at + 1 :] + (active if wrap else []):
        if ok and n != current:
            return n
    return None


def fallback(order: Column, usable: Column, current: Column) -> Column:
    """The first usable provider after the current one in an array of names; from the start if the current one isn't in it, null if there is none.

    usable: an array of the names that are healthy and whose breaker is closed.
    """
    later = F.slice(order, F.array_position(order, current).cast("int") + 1, F.size(order))
    return F.get(F.filter(later, lambda p: F.array_contains(usable, p)), F.lit(0))


def retry_wait(attempt: Column, seed: Column, status: Column, retry_after: Column) -> Column:
    """Seconds before a retry: after a 429 what Retry-After says, a minute if it isn't a number; else doubling up to five minutes, with a jitter of a tenth to a half by seed in [0, 1]."""
    base = F.least(F.pow(F.lit(2.0), attempt), F.lit(300.0))
    said = F.when(F.trim(retry_after).rlike("^[0-9]+$"), F.trim(retry_after).cast("double")).otherwise(F.lit(60.0))
    return F.when(status == 429, F.coalesce(said, F.lit(60.0))).otherwise(base + base * (F.lit(0.1) + F.lit(0.4) * seed))


def backoff(attempt: int, seed: float = 0.5) -> float:
    """Seconds before a retry: doubling up to five minutes, with a seeded jitter of a tenth to a half."""
    base = float(min(2**attempt, 300))
    return base + base * (0.1 + 0.4 * seed)
