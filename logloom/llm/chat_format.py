"""Chat formatting by event-sourced reconstruction: logs of streamed conversations are folded into messages, then rendered.

A log has one row per event: conversation, message (its place: messages are ordered by it), kind, role and text. Within a
message's conversation the events are in the order of ``order`` columns. Kinds:

    open        begins the message, or begins it anew; the text is what the event carries
    delta       appends to the message's text
    edit        replaces the message's text
    regenerate  begins the message anew, as ``open``, and removes every message after it

A message exists if it has an event after the last ``regenerate`` of an earlier message; its text is what its events since
its last ``open``, ``edit`` or ``regenerate`` have put together; its role is the last that any of its events names. So the
effect of a stretch of a log is small to state and stretches compose: conversations of more than ``hot_events`` events are
cut by range into stretches, which are folded in parallel and composed by aggregation, while all others are dealt whole to tasks, sorted
by sequence and folded as they stream by. Both give the same messages.

Rendering marks turns with control strings and breaks every control string inside a role or text with an escape that
``read_back`` undoes. Output rows hold whole turns: (conv, part, formatted, loss), where ``loss`` are the spans (begin and
end, in code points) of the texts of the roles that are trained on. A conversation is one row, or, where it is one of the
long ones, as many as it has pieces of ``PART`` characters; in order of ``part`` they are its formatted text.

Defined results: a null text is empty, a null role is no role (empty, if no event of the message names one); events of no
or an unknown kind have no effect; events without a message are left out; a null conversation is a conversation of its
own; a log row that is there twice acts twice; an empty log gives an empty table; other columns are ignored. A message of
any length that fits a row is taken whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import small, small_batches

#: Characters of a part of a long conversation, and of a delta of a conversation that is replayed from whole messages.
PART, DELTA = 1 << 20, 1_000
KINDS = ("open", "delta", "edit", "regenerate")
RENDERED = "conv bigint, part string, formatted string, loss array<struct<begin:int,end:int>>"


@dataclass(frozen=True)
class Template:
    """Marks around a turn: ``begin`` role ``head`` text ``end``. ``also`` are further control strings that texts may not spell."""

    begin: str = "[INST role="
    head: str = "]"
    end: str = "[/INST]</s>\n"
    also: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
    escape: str = "\\"
    trained: tuple[str, ...] = ("assistant",)
    control: re.Pattern = field(init=False, compare=False)
    undo: re.Pattern = field(init=False, compare=False)

    def __post_init__(self) -> None:
        marks = sorted({self.begin, self.end, self.end.strip(), *self.also})
        if any(len(m) < 2 or self.escape in m or self.head in m[:2] for m in marks) or len(self.head) != 1 or len(self.escape) != 1:
            raise ValueError("control strings have two characters at least; escape and head are one, the head none of a control string's first two, the escape none of any")
        if any(self.end.endswith(self.end[:k]) for k in range(1, len(self.end))):
            raise ValueError("an end that ends as it begins could be found too early")
        breaks = "|".join(re.escape(m) for m in marks)
        object.__setattr__(self, "control", re.compile(f"{re.escape(self.escape)}|(?=(?:{breaks}))(.)", re.S))
        object.__setattr__(self, "undo", re.compile(f"{re.escape(self.escape)}(.)", re.S))

    def escaped(self, text: str) -> str:
        """The text with an escape after the first character of every control string, and every escape doubled."""
        return self.control.sub(lambda m: m[0] + self.escape, text)

    def unescaped(self, text: str) -> str:
        return self.undo.sub(r"\1", text)

    def render(self, role: str, text: str) -> tuple[str, tuple[int, int] | None]:
        """The turn, and the span in it that is trained on."""
        name = self.escaped(role).replace(self.head, self.escape + self.head)
        front = f"{self.begin}{name}{self.head}"
        body = self.escaped(text)
        return f"{front}{body}{self.end}", (len(front), len(front) + len(body)) if role in self.trained else None

    def read_back(self, formatted: str) -> list[tuple[str, str, int, int]]:
        """(role, text, begin and end of the escaped text) of every turn."""
        out, at = [], 0
        while at < len(formatted):
            if not formatted.startswith(self.begin, at):
                raise ValueError("no turn begins here")
            head = name = at + len(self.begin)
            while formatted[head] != self.head:  # an escape guards the character behind it
                head += 1 + (formatted[head] == self.escape)
            body = head + 1
            end = formatted.index(self.end, body)
            out.append((self.unescaped(formatted[name:head]), self.unescaped(formatted[body:end]), body, end))
            at = end + len(self.end)
        return out


def replayed(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The log of finished conversations: an ``open`` per row, then its text in deltas of ``DELTA`` characters.

    Messages are in the order of turn (null first); equal turns by role (null first), then by hash of the text.
    """
    role, text, turn = rows[role_col].cast("string"), F.coalesce(rows[text_col].cast("string"), F.lit("")), rows[turn_col].cast("bigint")
    sign = F.when(turn.isNull(), "").otherwise(F.concat(F.when(turn < 0, "0").otherwise("1"), F.lpad(F.hex(turn), 16, "0")))
    message = F.concat_ws("\x01", sign, F.coalesce(role, F.lit("")), F.hex(F.xxhash64(text)), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    held = rows.select(rows[conv_col].cast("bigint").alias("conv"), message.alias("message"), role.alias("role"), text.alias("text"))
    starts = F.sequence(F.lit(1 - DELTA), F.length("text"), F.lit(DELTA))
    cut = held.select("conv", "message", "role", "text", F.posexplode(starts).alias("step", "at"))
    first = F.col("step") == 0
    return cut.select("conv", "message", "step", F.when(first, "open").otherwise("delta").alias("kind"), F.when(first, F.col("role")).alias("role"), F.when(first, F.lit(None)).otherwise(F.substring("text", F.greatest(F.col("at"), F.lit(1)), F.lit(DELTA))).alias("text"))


class Fold:
    """State of a stretch of one conversation's log: what it does to each message, and to those before."""

    __slots__ = ("cuts", "roles", "texts")

    def __init__(self) -> None:
        self.texts: dict[str, tuple[bool, list[str]]] = {}  # message: whether its earlier text is gone, and what follows
        self.roles: dict[str, str] = {}
        self.cuts: str | None = None  # the earliest message that was regenerated: all after it that came before are gone

    def event(self, message: str, kind: str, role: str | None, text: str | None) -> None:
        if role is not None:
            self.roles[message] = role
        if kind == "regenerate":
            for later in [m for m in self.texts if m > message]:
                del self.texts[later]
            self.cuts = message if self.cuts is None else min(self.cuts, message)
        if kind == "delta":
            self.texts.setdefault(message, (self.cuts is not None and self.cuts < message, []))[1].append(text or "")
        else:
            self.texts[message] = (True, [text or ""])

    def messages(self) -> Iterator[tuple[str, str, str]]:
        """(message, role, text) in order."""
        for message in sorted(self.texts):
            yield message, self.roles.get(message, ""), "".join(self.texts[message][1])


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, Fold]]:
    """The state of every conversation's rows in a task's sorted rows (conv, message, kind, role, text)."""
    last, fold = None, None
    for batch in batches:
        for conv, message, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if fold is None or conv != last:
                if fold is not None:
                    yield last, fold
                last, fold = conv, Fold()
            fold.event(message, kind, role, text)
    if fold is not None:
        yield last, fold


def _rendered(rows: Iterable[tuple], template: Template, part: int | None) -> Iterator[pa.RecordBatch]:
    """Output rows from (conv, message, role, text) in order: a conversation a row, or a new row beyond ``part`` characters."""
    out: list[tuple] = []
    held: list[str] = []
    spans: list[dict[str, int]] = []
    key, size, waiting = None, 0, 0
    for conv, message, role, text in rows:
        if held and (conv != key[0] or (part is not None and size > part)):
            out.append((*key, "".join(held), spans))
            waiting += size
            held, spans, size = [], [], 0
            if waiting > PART or len(out) >= 512:
                yield _batch(out)
                out, waiting = [], 0
        if not held:
            key = (conv, message)
        turn, span = template.render(role, text)
        if span:
            spans.append({"begin": size + span[0], "end": size + span[1]})
        held.append(turn)
        size += len(turn)
    if held:
        out.append((*key, "".join(held), spans))
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    conv, part, text, loss = zip(*rows, strict=True)
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(part, pa.string()), pa.array(text, pa.string()), pa.array(loss, span)], ["conv", "part", "formatted", "loss"])


def hot_conversations(log: DataFrame, hot_events: int) -> DataFrame:
    """Ids of conversations with more than ``hot_events`` events."""
    return small(log.groupBy("conv").agg(F.count("*").alias("n")).filter(F.col("n") > hot_events).select("conv"))


def composed(log: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """(conv, message, role, text) of long conversations: stretches of the log folded apart and put together by aggregation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()  # ranges are numbered in order, and a conversation has one stretch in each
        for conv, fold in _stretches(batches):
            rows = [(m, fold.roles.get(m), *fold.texts.get(m, (None, []))) for m in sorted({*fold.texts, *fold.roles})]
            message, role, fresh, text = zip(*rows, (fold.cuts, None, None, []), strict=True)
            n = len(rows)
            yield pa.RecordBatch.from_arrays([pa.array([conv] * (n + 1), pa.int64()), pa.array([piece] * (n + 1), pa.int32()), pa.array(message, pa.string()), pa.array(role, pa.string()), pa.array(fresh, pa.bool_()), pa.array(["".join(t) for t in text], pa.string()), pa.array([False] * n + [True])], ["conv", "piece", "message", "role", "fresh", "text", "cut"])

    dealt = log.repartitionByRange("conv", *order).sortWithinPartitions("conv", *order).select("conv", "message", "kind", "role", "text")
    found = dealt.mapInArrow(run, "conv bigint, piece int, message string, role string, fresh boolean, text string, cut boolean")
    later = Window.partitionBy("conv").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    stretch = found.filter("cut").select(F.col("conv").alias("c"), F.col("piece").alias("p"), F.min("message").over(later).alias("cut_later"))  # one row a stretch
    parts = found.filter("not cut").join(small(stretch), F.col("conv").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p")))
    after = Window.partitionBy("conv", "message").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    gone = F.col("fresh").isNull() | F.coalesce(F.col("cut_later") < F.col("message"), F.lit(False))
    marked = parts.withColumn("gone", gone).withColumn("gone", F.col("gone") | F.coalesce(F.max(F.col("fresh") & ~F.col("gone")).over(after), F.lit(False)))
    put = F.transform(F.array_sort(F.collect_list(F.when(~F.col("gone"), F.struct("piece", "text")))), lambda x: x["text"])
    whole = marked.groupBy("conv", "message").agg(F.max_by("role", F.when(F.col("role").isNotNull(), F.col("piece"))).alias("role"), F.array_join(put, "").alias("text"), F.min("gone").alias("gone"))
    return whole.filter("not gone").select("conv", "message", F.coalesce("role", F.lit("")).alias("role"), "text")


def format_log(log: DataFrame, template: Template | None = None, order: tuple[str, ...] = ("message", "step"), hot_events: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """Rendered conversations of a log (conv bigint; message string; kind; role; text; columns of ``order``): (whole ones, parts of long ones).

    The text of a log is shuffled once. Long conversations are found by a count of events, and only their rows are cut
    to stretches.
    """
    template = template or Template()
    small_batches(log.sparkSession)
    log = log.filter(F.col("kind").isin(*KINDS) & F.col("message").isNotNull())
    hot = hot_conversations(log, hot_events).withColumnRenamed("conv", "hot")
    same = F.col("conv").eqNullSafe(F.col("hot"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _rendered(((conv, *m) for conv, fold in _stretches(batches) for m in fold.messages()), template, None)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _rendered((row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)), template, PART)

    rest = log.join(hot, same, "left_anti").repartition("conv").sortWithinPartitions("conv", *order)
    usual = rest.select("conv", "message", "kind", "role", "text").mapInArrow(whole, RENDERED)
    long = composed(log.join(hot, same, "left_semi"), order).repartitionByRange("conv", "message").sortWithinPartitions("conv", "message")
    return usual, long.select("conv", "message", "role", "text").mapInArrow(parts, RENDERED)


def digests(rendered: tuple[DataFrame, DataFrame], template: Template | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from formatted text and spans.

    A whole conversation is read where it was rendered; the parts of a long one stream through one task in order.
    """
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple = ()
        counts = [0, 0, 0]
        turns = loss = None
        for batch in batches:
            out = []
            for conv, _, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if turns is None or (conv,) != key:
                    if turns is not None:
                        out.append((*key, *counts, turns.hexdigest(), loss.hexdigest()))
                    key, counts, turns, loss = (conv,), [0, 0, 0], hashlib.sha256(), hashlib.sha256()
                for role, said, _, _ in template.read_back(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    counts[0] += 1
                for s in spans:
                    said = template.unescaped(text[s["begin"] : s["end"]])
                    loss.update(said.encode())
                    counts[1] += len(said)
                counts[2] += len(text)
            if out:
                yield _digest_batch(out)
        if turns is not None:
            yield _digest_batch([(*key, *counts, turns.hexdigest(), loss.hexdigest())])

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    usual, long = rendered
    return usual.mapInArrow(run, schema).union(long.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(run, schema))


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    conv, n_turns, loss_chars, chars, turns, loss = zip(*rows, strict=True)
    columns = [pa.array(conv, pa.int64()), pa.array(n_turns), pa.array(turns), pa.array(loss_chars), pa.array(loss), pa.array(chars)]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
