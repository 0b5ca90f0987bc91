"""The same windows over a stream: tumbling counts with a watermark, and profiles in keyed state."""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.operators import snapshots
from logloom.operators.profile import SNAPSHOT, apply_window, state_of

EPOCH = datetime.date(1970, 1, 1)


def weekly_counts(events: DataFrame, ts: str, keys: list[str], anchor: datetime.date, late: str = "1 day", days: int = 7) -> DataFrame:
    """Rows per key and window; windows start on ``anchor``, since a stream has no first date of all rows. Rows later than
    the watermark allows are left out, which the batch form has no need to do."""
    offset = (anchor - EPOCH).days % days
    span = F.window(F.col(ts).cast("timestamp"), f"{days} days", f"{days} days", f"{offset} days")
    return events.withWatermark(ts, late).groupBy(span.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("window_start"), *keys, "n")


def profiles(decisions: DataFrame) -> DataFrame:
    """Snapshots as in ``operators.profile.fold``, one per user and micro-batch window, the state kept by Spark.

    Windows of a user must arrive in order; an earlier one than the state's is left out.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        held = json.loads(state.get[0]) if state.exists else {"before": None, "window": None, "items": []}
        day = datetime.date.fromisoformat
        items = [{**s, "first": day(s["first"]), "last": day(s["last"])} for s in held["items"]]
        before, last = held["before"] and day(held["before"]), held["window"]
        rows = pd.concat(list(frames))
        out = []
        for (window, date), part in rows.groupby(["window", "date"], sort=True):
            if last is not None and window <= last:
                continue
            part = part.sort_values("position").astype(object)
            items = apply_window(items, date, before or date, part.where(part.notna(), None).to_dict("records"))
            before, last = date, int(window)
            out += [(key[0], last, date.isoformat(), s["name"], s["confidence"], s["count"], s["first"].isoformat(), s["last"].isoformat(), state_of(s["first"], s["last"], date), s["event"]) for s in items]
        kept = [{**s, "first": s["first"].isoformat(), "last": s["last"].isoformat()} for s in items]
        state.update((json.dumps({"before": before and before.isoformat(), "window": last, "items": kept}),))
        yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in SNAPSHOT.split(", ")])

    return decisions.groupBy("user_id").applyInPandasWithState(step, SNAPSHOT, "state string", "append", "NoTimeout")


def nested_profiles(decisions: DataFrame) -> DataFrame:
    """Snapshots as in ``operators.snapshots.fold``, a user's nested snapshot kept by Spark from one micro-batch to the next.

    Windows of a user must arrive whole and in order; an earlier one than the state's is left out.
    """
    flat = {"source": "array<string>", "topics": snapshots.NESTED.split(", topics ")[1]}
    schema = ", ".join(f"{c} string" if c in flat else f"{c} {t}" for c, t in (x.split(" ", 1) for x in snapshots.NESTED.split(", ")))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        before, last, items = (json.loads(state.get[0]) if state.exists else [None, None, "[]"])
        items, before = snapshots.unpacked(items), before and datetime.date.fromisoformat(before)
        rows = pd.concat(list(frames)).sort_values(list(snapshots.ORDER)).astype(object)
        rows = rows.where(rows.notna(), None)
        out = []
        for window, part in rows.groupby("window", sort=True):
            if last is not None and window <= last:
                continue
            found = [r | {"topics": json.loads(r["topics"] or "[]")} for r in part.to_dict("records")]
            date = found[0]["date"]
            items = snapshots.step(items, date, before or date, found)
            before, last = date, int(window)
            out += [r | {c: json.dumps(r[c]) for c in flat} for r in snapshots.snapshot_rows(key[0], last, date, items)]
        state.update((json.dumps([before and before.isoformat(), last, snapshots.packed(items)]),))
        yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in schema.split(", ")])

    rows = decisions.filter(F.col("user_id").isNotNull() & F.col("window").isNotNull() & F.col("date").isNotNull())
    sent = rows.select(F.col("user_id").cast("string").alias("user_id"), *snapshots.COLUMNS[1:-1], *snapshots.ORDER[1:], F.to_json("topics", {"ignoreNullFields": "false"}).alias("topics"))
    made = sent.groupBy("user_id").applyInPandasWithState(step, schema, "state string", "append", "NoTimeout")
    return made.select(*[F.from_json(c, flat[c]).alias(c) if c in flat else c for c in made.columns])
