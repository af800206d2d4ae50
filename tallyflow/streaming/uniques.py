"""First visits per day, returning users and corrected new-visitor flags, kept in keyed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallyflow.streaming.combine import keep_edge

DAY_MS = 86_400_000
EPOCH = date(1970, 1, 1)
SALTS = 16


#: Buckets that keys are dealt to, each one entry of the state: a micro-batch reads and writes state per bucket, not per key.
BUCKETS = 4096


def bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("_bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))


class FirstPerDay(StatefulProcessor):
    """Emits the earliest row, its ``columns``, of a key for each (kind, day) not seen before.

    A day's marks stay until the watermark is a day past its end, so a late or repeated row never counts twice. One state
    value and one timer per bucket of keys and micro-batch; ``keys`` and ``marks`` of the value lie side by side.
    """

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        texts = T.ArrayType(T.StringType())
        self.seen = handle.getValueState("seen", T.StructType().add("keys", texts).add("marks", texts))

    @staticmethod
    def end_ms(mark: str) -> int:
        return (date.fromisoformat(mark[:10]) - EPOCH).days * DAY_MS + 2 * DAY_MS

    def held(self) -> set[tuple[str | None, str]]:
        state = self.seen.get()
        return set(zip(state[0], state[1])) if state else set()

    def hold(self, marks: set[tuple[str | None, str]]) -> None:
        self.seen.update(([k for k, _ in marks], [m for _, m in marks]))
        self.handle.registerTimer(min(self.end_ms(d) for d in {m[:10] for _, m in marks}))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first: dict[tuple[str | None, str], Row] = {}
        for row in rows:
            mark = (row.key, f"{row.day}|{row.kind}")
            if mark not in first or row.ts < first[mark].ts:
                first[mark] = row
        held = self.held()
        fresh = [m for m in first if m not in held]
        if fresh:
            self.hold(held.union(fresh))
        for mark in fresh:
            yield Row(**{c: first[mark][c] for c in self.columns})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        live = {m for m in self.held() if self.end_ms(m[1]) > now}
        if live:
            self.hold(live)
        else:
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_per_day(events: DataFrame, key: str, kind: str | None = None, keep: Sequence[str] = (), lateness: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """First event per key, kind and day, with the columns ``keep`` of that event. ``events`` has ``ts``."""
    rows = events.select(
        F.col(key).cast("string").alias("key"), (F.col(kind) if kind else F.lit("")).cast("string").alias("kind"), F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts", *keep
    )
    few = keep_edge(rows, ["key", "kind", "day"], ["ts"]).withWatermark("ts", lateness)
    return bucketed(few, buckets).groupBy("_bucket").transformWithState(FirstPerDay(few.columns), few.schema, "Append", "EventTime", eventTimeColumnName="ts")


class LoginGap(StatefulProcessor):
    """Daily unique logins of a user; a login ``gap`` or more days after the last one marks a returning user.

    State holds the last login day of each user of a bucket, users and days side by side.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        texts = T.ArrayType(T.StringType())
        self.last = handle.getValueState("last", T.StructType().add("keys", texts).add("days", texts))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        days: dict[tuple[str | None, str], datetime] = {}
        for row in rows:
            at = (row.key, row.day)
            days[at] = min(days.get(at, row.ts), row.ts)
        state, changed = self.last.get(), False
        last: dict[str | None, str] = dict(zip(state[0], state[1])) if state else {}
        for user, day in sorted(days, key=lambda at: at[1]):
            held = last.get(user)
            if held is not None and day <= held:
                continue
            away = (date.fromisoformat(day) - date.fromisoformat(held)).days if held else 0
            last[user], changed = day, True
            yield Row(key=user, day=day, ts=days[user, day], uu_ct=1, back_ct=int(away >= self.gap))
        if changed:
            self.last.update((list(last), list(last.values())))

    def close(self) -> None:
        pass


def login_return(logins: DataFrame, key: str, gap: int = 8, lateness: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """One row per user and login day with uu_ct 1 and back_ct 1 when the user had been away ``gap`` days."""
    rows = logins.select(F.col(key).cast("string").alias("key"), F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts")
    few = keep_edge(rows, ["key", "day"], ["ts"]).withWatermark("ts", lateness)
    out = "key string, day string, ts timestamp, uu_ct int, back_ct int"
    return bucketed(few, buckets).groupBy("_bucket").transformWithState(LoginGap(gap), out, "Append", "EventTime", eventTimeColumnName="ts")


class FirstSeen(StatefulProcessor):
    """Once per key, day and salt: the day the key counts as new. A key that first shows up unflagged was new the day before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", T.StructType().add("new_day", "string").add("told", T.ArrayType(T.StringType())))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first: dict[str, dict[int, Row]] = {}
        for row in rows:
            salts = first.setdefault(row.day, {})
            if row.salt not in salts or row.ts < salts[row.salt].ts:
                salts[row.salt] = row
        state = self.state.get()
        new_day, told = (state[0], set(state[1])) if state else (None, set())
        for day in sorted(first):
            if new_day is None:
                new_day = day if min(first[day].values(), key=lambda r: r.ts).is_new == "1" else str(date.fromisoformat(day) - timedelta(days=1))
            for salt, row in first[day].items():
                mark = f"{day}|{salt}"
                if mark not in told:
                    told.add(mark)
                    yield Row(key=key[0], day=day, salt=salt, ts=row.ts, new_day=new_day)
        # days that the watermark has closed get no more rows
        open_from = str(date.fromtimestamp(0) + timedelta(milliseconds=max(0, timerValues.getCurrentWatermarkInMs())) - timedelta(days=1))
        self.state.update((new_day, sorted(d for d in told if d >= open_from)))

    def close(self) -> None:
        pass


def fix_is_new(log: DataFrame, key: str, lateness: str = "1 day") -> DataFrame:
    """Log rows with the new-visitor flag kept only on the visitor's first day.

    State holds one small row per visitor. Its answer, one row per visitor, day and salt that has log rows, is joined to the log
    on (visitor, day, salt), so a visitor with very many rows spreads over ``SALTS`` tasks and there are no more answers than rows.
    """
    salt = F.pmod(F.hash("ts"), F.lit(SALTS))
    rows = log.select(F.col(key).alias("key"), F.date_format("ts", "yyyy-MM-dd").alias("day"), salt.alias("salt"), "ts", "is_new")
    few = keep_edge(rows, ["key", "day", "salt"], ["ts"]).withWatermark("ts", lateness)
    out = "key string, day string, salt int, ts timestamp, new_day string"
    told = few.groupBy("key").transformWithState(FirstSeen(), out, "Append", "EventTime", eventTimeColumnName="ts")
    told = told.select("key", F.col("day").alias("_day"), F.col("ts").alias("_ts"), "new_day", F.col("salt").alias("_salt"))

    salted = log.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).withColumn("salt", salt).withWatermark("ts", lateness)
    same = (F.col(key) == F.col("key")) & (F.col("day") == F.col("_day")) & (F.col("salt") == F.col("_salt"))
    near = F.expr("ts >= _ts - interval 1 day and ts <= _ts + interval 1 day")
    joined = salted.join(told, same & near, "inner")
    fixed = F.when((F.col("is_new") == "1") & (F.col("day") != F.col("new_day")), "0").otherwise(F.col("is_new"))
    return joined.withColumn("fixed_is_new", fixed).select(*log.columns, "day", "fixed_is_new")
