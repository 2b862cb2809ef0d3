"""Rolling quotas, freezes and latest state, as batch windows and as Structured Streaming."""

from __future__ import annotations

from collections import deque

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rolling(df: DataFrame, key: str, ts: str, seconds: int, value: Column | None = None, lower_open: bool = True) -> Column:
    """Count, or sum of a value, over (now - seconds, now], or with the lower edge closed.

    Rows at the same instant count together; microseconds are exact.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    w = W.partitionBy(key).orderBy(at).rangeBetween(-(seconds * 1_000_000 - (1 if lower_open else 0)), 0)
    return (F.count(F.lit(1)) if value is None else F.sum(value)).over(w)


def rolling_rows(df: DataFrame, key: str, ts: str, seconds: int, values: dict[str, Column], slice_s: int = 86_400, lower_open: bool = True) -> DataFrame:
    """df with sums of values over (now - seconds, now] a key, the lower edge open or closed.

    Time is cut into slices, each its own partition, so a key with most of the rows isn't one
    task; the rows at a slice's end are seen again, as history only, in the next one.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    wide, reach = slice_s * 1_000_000, seconds * 1_000_000
    own = F.floor(at / F.lit(wide))
    late = at >= (own + 1) * wide - reach
    parts = F.when(late, F.array(F.struct(own.alias("part"), F.lit(True).alias("mine")), F.struct((own + 1).alias("part"), F.lit(False).alias("mine")))).otherwise(F.array(F.struct(own.alias("part"), F.lit(True).alias("mine"))))
    x = df.select("*", F.explode(parts).alias("__s")).select("*", F.col("__s.part").alias("__part"), F.col("__s.mine").alias("__mine")).drop("__s")
    w = W.partitionBy(key, "__part").orderBy(at).rangeBetween(-(reach - (1 if lower_open else 0)), 0)
    return x.withColumns({n: F.sum(c).over(w) for n, c in values.items()}).where("__mine").drop("__part", "__mine")


def freeze_seconds(hits: Column) -> Column:
    """Escalating freeze: 900 s, 2700 s, then permanent (-1); none before the first hit."""
    return F.when(hits <= 0, 0).when(hits == 1, 900).when(hits == 2, 2700).otherwise(-1)


def attempts(key: list[str], order: list[str]) -> Column:
    """Attempt number of a row within its key."""
    return F.row_number().over(W.partitionBy(*key).orderBy(*order))


def stream_quota(events: DataFrame, ts: str, key: str, window: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Calls a key and window on a stream; late rows are dropped by the watermark, so state stays bounded."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, window), key).agg(F.count(F.lit(1)).alias("calls")).select(F.col("window.start").alias("window_start"), key, "calls")


def stream_dedup(events: DataFrame, ts: str, key: str, late: str = "10 minutes") -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there, once, into a table in memory (tests and small results)."""
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def seconds_to_midnight(ts: Column) -> Column:
    """Seconds until the next UTC day begins."""
    return F.lit(86_400.0) - F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(86_400_000_000)) / F.lit(1e6)


def admitted(rows: list[tuple[float, int]], rpm: int, tpm: int, rpd: int, span: float = 60.0, wait: bool = True) -> list[tuple[float, str]]:
    """(time of admission, state) of requests (time, tokens) in order of arrival, under limits a minute and a UTC day.

    A request waits until enough earlier ones have left the window (now - span, now]; one that
    alone is beyond the tokens a minute, or beyond the day's requests, is refused. Without `wait`
    one that would have to wait is refused as well.
    """
    window: deque = deque()
    tokens, day, used, clock, out = 0, None, 0, 0.0, []
    for at, need in rows:
        now = clock = max(clock, at)
        if need > tpm:
            out.append((now, "too_large"))
            continue
        while True:
            while window and window[0][0] <= now - span:
                tokens -= window.popleft()[1]
            if int(now // 86_400) != day:
                day, used = int(now // 86_400), 0
            if used >= rpd:
                out.append((now, "day_spent"))
                break
            if len(window) < rpm and tokens + need <= tpm:
                window.append((now, need))
                tokens, used, clock = tokens + need, used + 1, now
                out.append((now, "admitted"))
                break
            if not wait:
                out.append((now, "refused"))
                break
            gone, left, n = 0, tokens, len(window)
            for t, k in window:
                gone, left, n = t, left - k, n - 1
                if n < rpm and left + need <= tpm:
                    break
            now = clock = gone + span
    return out


def admit(df: DataFrame, key: str, ts: str, tokens: str, rpm: int, tpm: int, rpd: int) -> DataFrame:
    """df with `admitted_at` (seconds) and `state`: requests of each project in order of arrival under its limits.

    A limiter is one queue: what is admitted depends on all before, so a project's requests are one
    group. They are a log of at most rpd admitted requests a day, which bounds the group by its days.
    """
    fields = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by(ts)
        at = pc.cast(pc.cast(t.column(ts), pa.timestamp("us")), pa.int64()).to_pylist()
        got = admitted([(a / 1e6, n) for a, n in zip(at, t.column(tokens).to_pylist())], rpm, tpm, rpd)
        return t.append_column("admitted_at", pa.array([x for x, _ in got], pa.float64())).append_column("state", pa.array([s for _, s in got], pa.string()))

    return df.groupBy(key).applyInArrow(run, f"{fields}, admitted_at double, state string")


def stream_freezes(hits: DataFrame, ts: str, group: str) -> DataFrame:
    """(group, hits, frozen_until) on a stream of refusals: 15 minutes, 45 minutes, then for good (null)."""

    def run(k, batches, state):
        n, until = state.get if state.exists else (0, 0.0)
        for pdf in batches:
            for at in sorted(pdf[ts].astype("int64") // 1000 if str(pdf[ts].dtype).endswith("[ns]") else pdf[ts].astype("int64")):
                n += 1
                until = at / 1e6 + (900 if n == 1 else 2700) if n < 3 else -1.0
        state.update((n, until))
        yield pd.DataFrame({group: [k[0]], "hits": [n], "until_s": [until]})

    return hits.groupBy(group).applyInPandasWithState(run, f"`{group}` string, hits int, until_s double", "n int, until double", "update", "NoTimeout")


def frozen(now: Column, until_s: Column) -> Column:
    """Whether a group is frozen at a time; until_s is -1 for good, null if it never was."""
    return F.coalesce((until_s < 0) | (until_s > F.unix_micros(now.cast("timestamp")) / F.lit(1e6)), F.lit(False))
