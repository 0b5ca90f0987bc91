"""Nested snapshots: interests with topics, and topics with sources and evidence, folded over windows.

A window brings deltas (interests seen in it, with their topics) and decisions (merge a delta into an interest of the
snapshot, or add it). ``decisions_for`` completes the decisions and joins the topics to them; ``fold`` applies them in order of
time: what a decision names is boosted topic by topic, topics and interests that nothing names decay by the days since
the snapshot before, and what has faded below the prune limit goes. Windows without a decision still let a user's
snapshot decay, if they are in the rows (an empty ``name`` stands for such a window).

A user's windows stream through one task in order; only the user's snapshot is held, which pruning and decay keep
small, so a user with many windows costs time but not memory.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterable, Iterator
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions import dates
from logloom.operators.profile import apply_window, clamp, fading, state_of

EVIDENCE = "array<struct<date:string,source:string,action:string>>"
#: What a delta says of its topics.
TOPICS = f"array<struct<topic:string,count:int,source:array<string>,intent:string,evidence:{EVIDENCE}>>"
#: One row per user, window and interest of the snapshot after the window.
NESTED = (
    "user_id string, window int, date string, place int, name string, activity string, confidence double, count int, first_date string, last_date string, state string, event string, "
    f"source array<string>, topics array<struct<topic:string,count:int,source:array<string>,intent:string,evidence:{EVIDENCE},first_date:string,last_date:string,confidence:double>>"
)
RECENT = 3
#: Order of a user's decisions, and what the fold reads of each.
ORDER = ("window", "late", "position")
COLUMNS = ("user_id", "window", "date", "action", "name", "target", "result", "activity", "delta_activity", "topics")


def decisions_for(deltas: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions in order with the topics of their deltas; a delta that no decision of its window names is added at the end.

    ``deltas`` has user_id, window, date, position, name, activity and topics (``TOPICS``), ``decisions`` user_id, window, position,
    action, name (of the delta), target (of the snapshot), result (name after a merge) and activity. Names meet in any case; of
    deltas of one name the last counts, as the later of two keys in a map does. A decision on no delta has no topics.
    """
    keys = ["user_id", "window", "__k"]
    last = Window.partitionBy(*keys).orderBy(F.desc("position"))
    keyed = deltas.withColumn("__k", F.lower("name"))
    known = keyed.withColumn("__r", F.row_number().over(last)).filter("__r = 1").select(*keys, "topics", F.col("activity").alias("delta_activity"), "date")
    named = decisions.withColumn("__k", F.lower("name"))
    missing = keyed.join(named.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit(1).alias("late"), "position", F.lit("add").alias("action"), "name", F.lit(None).cast("string").alias("target"), F.lit(None).cast("string").alias("result"), F.lit(None).cast("string").alias("activity"))
    every = named.select(*keys, F.lit(0).alias("late"), "position", F.lower(F.coalesce("action", F.lit("add"))).alias("action"), "name", "target", "result", "activity").union(missing)
    days = deltas.groupBy("user_id", "window").agg(F.max("date").alias("__date"))
    out = every.join(known, keys, "left").join(days, ["user_id", "window"])
    return out.select("user_id", "window", F.coalesce("date", "__date").alias("date"), "late", "position", *COLUMNS[3:])


def united(a: Iterable, b: Iterable) -> list:
    """``a`` as it is, then what ``b`` adds to it."""
    held = list(a)
    return held + [x for x in dict.fromkeys(b) if x not in held]


def recent(*evidence: list[dict]) -> list[dict]:
    """The latest of several lists of evidence, in order of day: dated ones only, the first of equal ones."""
    dated = {}
    for e in (e for held in evidence for e in held or []):
        if (day := day_of(e["date"])) is not None:
            dated.setdefault((e["date"], e["source"], e["action"]), (day, e))
    return [e for _, e in sorted(dated.values(), key=lambda x: x[0])[-RECENT:]]


def day_of(text: str | None) -> datetime.date | None:
    """The day of ``yyyyMMdd`` or of an ISO date or time."""
    try:
        return datetime.datetime.fromisoformat(text.strip()).date() if text else None
    except ValueError:
        return None


def key_of(topic: dict) -> str:
    return (topic["topic"] or "").strip().lower()


def lasting(items: list[dict]) -> list[dict]:
    return sorted((x for x in items if x["confidence"] > dates.PRUNE), key=lambda x: -x["confidence"])


def new_topic(t: dict, now: datetime.date) -> dict:
    return {"topic": t["topic"] or "", "count": 1, "source": list(t["source"] or []), "intent": t["intent"] or "", "evidence": (t["evidence"] or [])[-RECENT:], "first": now, "last": now, "confidence": dates.INITIAL}


def one_by_key(topics: list[dict]) -> dict[str, dict]:
    """Topics of a snapshot by key; what stands there under one key is one topic."""
    out: dict[str, dict] = {}
    for t in topics:
        if not (k := key_of(t)):
            continue
        if (s := out.get(k)) is None:
            out[k] = t
        else:
            out[k] = s | {"count": s["count"] + t["count"], "source": united(s["source"], t["source"]), "evidence": recent(s["evidence"], t["evidence"]), "confidence": max(s["confidence"], t["confidence"]), "first": min(s["first"], t["first"]), "last": max(s["last"], t["last"])}
    return out


def grown_topics(held: list[dict], seen: list[dict], now: datetime.date, factor: float) -> list[dict]:
    """Topics of an interest after a delta: those it names are boosted, new ones begin, the rest decay."""
    known = one_by_key(held)
    out = []
    for t in seen:
        s = known.get(key_of(t))
        if s is not None:
            out.append(s | {"count": s["count"] + (1 if t["count"] is None else t["count"]), "source": united(s["source"], t["source"] or []), "intent": t["intent"] or s["intent"], "evidence": recent(s["evidence"], t["evidence"]), "last": now, "confidence": clamp(dates.BOOST * s["confidence"] + 1 - dates.BOOST)})
        elif key_of(t):
            out.append(new_topic(t, now))
    named = {key_of(t) for t in seen}
    return lasting(out + [t | {"confidence": clamp(t["confidence"] * factor)} for k, t in known.items() if k not in named])


def sources_of(topics: list[dict]) -> list[str]:
    return list(dict.fromkeys(s for t in topics for s in t["source"]))


def decided(d: dict[str, Any], target: dict | None, now: datetime.date, factor: float) -> dict[str, Any]:
    """The interest that a decision leaves behind."""
    seen = d["topics"] or []
    if target is None:
        topics = lasting([new_topic(t, now) for t in seen])
        return {"name": d["name"] or d["result"] or "", "activity": d["activity"] or d["delta_activity"] or "", "topics": topics, "source": sources_of(topics), "confidence": dates.INITIAL_MULTI if len(seen) >= 2 else dates.INITIAL, "count": 1, "first": now, "last": now, "event": "added"}
    topics = grown_topics(target["topics"], seen, now, factor)
    name = (d["result"] if d["action"] == "merge" else None) or target["name"]
    return target | {"name": name, "activity": d["activity"] or target["activity"], "topics": topics, "source": sources_of(topics), "confidence": clamp(dates.BOOST * target["confidence"] + 1 - dates.BOOST), "count": target["count"] + 1, "last": now, "event": "boosted"}


def faded(s: dict[str, Any], now: datetime.date, before: datetime.date) -> dict[str, Any]:
    factor = fading(now, before)
    topics = lasting([t | {"confidence": clamp(t["confidence"] * factor), "evidence": t["evidence"][-RECENT:]} for t in s["topics"]])
    return s | {"confidence": clamp(s["confidence"] * factor), "topics": topics, "source": sources_of(topics) if topics else s["source"], "event": "decayed"}


def step(state: list[dict], date: datetime.date, before: datetime.date, decisions: list[dict]) -> list[dict]:
    return apply_window(state, date, before, [d for d in decisions if d["name"] or d["target"] or d["result"]], partial(decided, factor=fading(date, before)), faded)


def snapshot_rows(user: str, window: int, date: datetime.date, state: list[dict]) -> Iterator[dict]:
    for place, s in enumerate(state):
        topics = [{k: v for k, v in t.items() if k not in ("first", "last")} | {"first_date": t["first"].isoformat(), "last_date": t["last"].isoformat()} for t in s["topics"]]
        yield {"user_id": user, "window": window, "date": date.isoformat(), "place": place, "name": s["name"], "activity": s["activity"], "confidence": s["confidence"], "count": s["count"], "first_date": s["first"].isoformat(), "last_date": s["last"].isoformat(), "state": state_of(s["first"], s["last"], date), "event": s["event"], "source": s["source"], "topics": topics}


def fold(decisions: DataFrame) -> DataFrame:
    """Snapshots (``NESTED``) after every window of every user, from the rows of ``decisions_for``.

    Rows without a user or window take no part; no rows give no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(decisions.sparkSession.createDataFrame([], NESTED).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user = window = date = before = None
        state: list[dict] = []
        held: list[dict] = []
        out: list[dict] = []

        def close() -> None:
            nonlocal state, before, held
            if held:
                state = step(state, date, before or date, held)
                out.extend(snapshot_rows(user, window, date, state))
                before, held = date, []

        for batch in batches:
            for r in batch.to_pylist():
                if r["user_id"] != user or r["window"] != window:
                    close()
                    if r["user_id"] != user:
                        state, before = [], None
                    user, window, date = r["user_id"], r["window"], r["date"]
                held.append(r)
            if len(out) > 2000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        close()
        yield pa.RecordBatch.from_pylist(out, schema)

    rows = decisions.filter(F.col("user_id").isNotNull() & F.col("window").isNotNull() & F.col("date").isNotNull())
    dealt = rows.withColumn("user_id", F.col("user_id").cast("string")).repartition("user_id").sortWithinPartitions("user_id", *ORDER)
    return dealt.select(*COLUMNS).mapInArrow(run, NESTED)


def packed(state: list[dict]) -> str:
    """A snapshot as text, for the state of a stream."""
    return json.dumps(state, default=datetime.date.isoformat)


def unpacked(text: str) -> list[dict]:
    day = datetime.date.fromisoformat
    return [s | {"first": day(s["first"]), "last": day(s["last"]), "topics": [t | {"first": day(t["first"]), "last": day(t["last"])} for t in s["topics"]]} for s in json.loads(text)]
