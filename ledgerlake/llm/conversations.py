"""Conversations with missing, empty, repeated, cut off and misplaced turns, and their cheapest repair.

Turns are dealt in ranges of conversation and turn, so a conversation of any length is many tasks.
Within a range the tables of `turn_blocks` do the work; between ranges only what the turns of a range
make of each vector, and of each state, is handed on: two small rows for a range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import turn_blocks
from ledgerlake.llm.ranges import in_order, part_of
from ledgerlake.llm.tables import stored
from ledgerlake.llm.turn_blocks import FOLLOW, INITIALS, NEXT, NOTHING, ROLE, after

#: What stands for a null role or text, and for a null id in the checksum of `damage`.
NULL = " "
SPACE = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
#: Rows and characters of text of a batch that is handed on.
ROWS, CHARACTERS = 5_000, 1 << 22

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
_CONVERSATION, _TURN, _DECISION = range(3)


def damage(
    conversations: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The four columns of the turns after faults that the CRC-32 of `conv_id:turn`, modulo 20, chooses:
    0 drops the turn, 1 empties its text, 2 removes `.!?`, 3 repeats it, 4 makes it the user's."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NULL))
    fault = F.crc32(F.concat(as_text(conv_id), F.lit(":"), as_text(turn))) % 20
    broken = (
        F.when(fault == 1, "")
        .when(fault == 2, F.translate(as_text(text), "".join(STOPS), ""))
        .otherwise(as_text(text))
    )
    return conversations.where(fault != 0).select(
        F.col(conv_id),
        F.col(turn),
        F.when(fault == 4, "user").otherwise(as_text(role)).alias(role),
        broken.alias(text),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


class Range(NamedTuple):
    """What the neighbours of a range need to know of it."""

    runs: int  # conversations with turns in it
    first: Any  # their first and last ids
    last: Any
    initial: str  # of its last turn's role
    before: list[int]  # per vector behind its first run, the vector before it


def _turns(rows: DataFrame) -> DataFrame:
    """conv, turn, mark (of role and text), who, initial, blank, cut: what decides, without the texts."""
    text = F.btrim("text", F.lit(SPACE))
    initial = F.left("role", F.lit(1))
    who = F.coalesce(*[F.when(initial == c, k) for k, c in enumerate(INITIALS)], F.lit(len(INITIALS)))
    return rows.select(
        "conv",
        "turn",
        _mark().alias("mark"),
        who.cast("byte").alias("who"),
        F.when(who < len(INITIALS), initial).otherwise("").alias("initial"),
        (text == "").alias("blank"),
        (~F.right(text, F.lit(1)).isin(*STOPS)).alias("cut"),
    )


def _mark() -> Column:
    sized = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return F.unhex(F.sha2(sized, 256))


def _with_duplicates(turns: DataFrame) -> DataFrame:
    """The turns, in order, with whether role and text were seen earlier in their conversation.

    Only the first place of each text is looked up, and a place is one row, so a text that makes up
    most of a conversation is no heavy key.
    """
    placed = in_order(turns, ["conv", "turn", "mark"], "conversation-turns")
    firsts = placed.where("not blank").groupBy("conv", "mark").agg(F.min("_at").alias("_at"))
    seen = firsts.select("_at", F.lit(False).alias("again"))
    joined = placed.join(seen, "_at", "left").withColumn("part", part_of())
    return stored(joined.withColumn("again", F.coalesce("again", ~F.col("blank"))), "conversation-faults")


def _runs(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A range in order, the kinds of its turns, and where its conversations begin and the last ends."""
    table = table.sort_by("_at")
    conv = table.column("conv").to_pylist()
    begins = [k for k in range(len(conv)) if k == 0 or conv[k] != conv[k - 1]]
    column = lambda c: table.column(c).to_numpy()
    kinds = 1 + 2 * column("who").astype(np.uint8) + column("cut").astype(np.uint8)
    kinds[column("blank").astype(bool) | column("again").astype(bool)] = 0
    return table, kinds, np.array([*begins, len(conv)])


def _ranges(turns: DataFrame) -> dict[int, Range]:
    """What is known of each range: one row of bounded size for each."""
    kind = turns.schema["conv"].dataType.simpleString()

    def summary(table: pa.Table) -> pa.Table:
        table, kinds, bounds = _runs(table)
        row = {
            "part": table.column("part")[0].as_py(),
            "runs": len(bounds) - 1,
            "first": table.column("conv")[0].as_py(),
            "last": table.column("conv")[-1].as_py(),
            "initial": table.column("initial")[-1].as_py(),
            "before": turn_blocks.vectors_before(kinds[: bounds[1]]).tolist(),
        }
        types = [pa.int64(), pa.int32(), *[table.schema.field("conv").type] * 2, pa.string(), pa.list_(pa.int32())]
        return pa.table({k: pa.array([v], t) for (k, v), t in zip(row.items(), types, strict=True)})

    schema = f"part long, runs int, first {kind}, last {kind}, initial string, before array<int>"
    found = turns.groupBy("part").applyInArrow(summary, schema).collect()
    return {r["part"]: Range(*r[1:]) for r in sorted(found, key=lambda r: r["part"])}


def _goes_on(ranges: dict[int, Range]) -> dict[int, int]:
    """Each range whose last conversation goes on in the next one, and that."""
    parts = list(ranges)
    pairs = zip(parts, parts[1:], strict=False)
    return {a: b for a, b in pairs if ranges[a].last == ranges[b].first}


def _behind(ranges: dict[int, Range]) -> dict[int, int]:
    """Per range, the vector behind its last conversation's turns there."""
    end, after_it = turn_blocks.tables().end, _goes_on(ranges)
    found: dict[int, int] = {}
    for part in reversed(ranges):
        after_part = after_it.get(part)
        if after_part is None:
            found[part] = end
        else:
            whole = ranges[after_part].runs == 1
            found[part] = ranges[after_part].before[found[after_part] if whole else end]
    return found


def _states(turns: DataFrame, ranges: dict[int, Range], behind: dict[int, int]) -> dict[int, int]:
    """Per range, what was said last in its first conversation before it."""
    on = _goes_on(ranges)

    def ends(table: pa.Table) -> pa.Table:
        _, kinds, bounds = _runs(table)
        part = table.column("part")[0].as_py()
        found = []
        if part in on:
            starts = range(4) if len(bounds) == 2 else [NOTHING] * 4
            found = [turn_blocks.trace(kinds[bounds[-2] :], behind[part], s)[1] for s in starts]
        return pa.table({"part": pa.array([part], pa.int64()), "ends": pa.array([found], pa.list_(pa.int32()))})

    rows = turns.groupBy("part").applyInArrow(ends, "part long, ends array<int>").collect()
    found = {r["part"]: r["ends"] for r in rows}
    states = dict.fromkeys(ranges, NOTHING)
    for part, following in on.items():  # in order
        states[following] = found[part][states[part]]
    return states


def _decisions(turns: DataFrame) -> DataFrame:
    """conv, turn, mark, place, edits (of the turn, what is inserted before it included; at the end of
    the conversation what is inserted behind it too), fault and illegal, a row for each turn."""
    ranges = _ranges(turns)
    behind = _behind(ranges)
    states, on = _states(turns, ranges, behind), _goes_on(ranges)
    end, tails = turn_blocks.tables().end, turn_blocks.tables().tails
    previous = {following: ranges[part].initial for part, following in on.items()}

    def decide(table: pa.Table) -> pa.Table:
        table, kinds, bounds = _runs(table)
        part = table.column("part")[0].as_py()
        edits: list[str] = []
        for k, (first, last) in enumerate(zip(bounds, bounds[1:], strict=False)):
            is_last = k == len(bounds) - 2
            start = states[part] if k == 0 else NOTHING
            found, state = turn_blocks.trace(kinds[first:last], behind[part] if is_last else end, start)
            if not (is_last and part in on):
                found[-1] += tails[state]
            edits += found
        blank, again, cut = (table.column(c).to_pylist() for c in ("blank", "again", "cut"))
        faults = [
            BLANK if b else DUPLICATE if a else TRUNCATED if c else None
            for b, a, c in zip(blank, again, cut, strict=True)
        ]
        initials = table.column("initial").to_pylist()
        illegal = [a + b not in FOLLOW for a, b in zip([previous.get(part, ""), *initials], initials, strict=False)]
        for k, first in enumerate(bounds[:-1]):
            if k > 0 or part not in previous:
                illegal[first] = False
        return pa.table(
            {
                "conv": table.column("conv"),
                "turn": table.column("turn"),
                "mark": table.column("mark"),
                "place": table.column("_at"),
                "edits": pa.array(edits, pa.string()),
                "fault": pa.array(faults, pa.string()),
                "illegal": pa.array(illegal, pa.bool_()),
            }
        )

    kind = turns.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, turn long, mark binary, place long, edits string, fault string, illegal boolean"
    return turns.groupBy("part").applyInArrow(decide, schema)


def _handed_on(rows: Iterator[tuple], schema: pa.Schema, text: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded length."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[text] or "")
        if len(held) >= ROWS or size >= CHARACTERS:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _each(batches, *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns], strict=True)


def repaired(
    conversations: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    known: DataFrame | None = None,
) -> DataFrame:
    """The edits of every conversation, in order: `conv_id`, `turn`, edit, `role`, `text`, fault, illegal.

    A conversation's turns are taken by `turn`, nulls first; equal turns by a hash of role and text.
    Null roles and texts are one space. A row's first fault counts: blank, duplicate (role and text
    stood earlier), truncated (no stop at the end); illegal tells that its role may not follow the row
    before.

    edit is K (kept), R (given to another role), D (deleted; blank and duplicate rows have to be) or
    I (inserted, with an empty text and no turn), so that the first letters of the roles read
    `(s?(ua)+)?`: the cheapest edits, of equally cheap ones those of which the letters come first. A
    deleted row has its own role and a null text. Null ids are one conversation; repeated rows are
    duplicates. A conversation of `known` (its column `conv_id`) without rows is one row without edit.
    Other columns are not read.

    A conversation's rows stand in one partition, in their order, and pass through it one by one.
    """
    rows = conversations.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(NULL)).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(NULL)).alias("text"),
    )
    decisions = stored(_decisions(_with_duplicates(_turns(rows))), "conversation-edits")
    texts = rows.withColumns({"mark": _mark(), "what": F.lit(_TURN)})
    stream = texts.unionByName(decisions.withColumn("what", F.lit(_DECISION)), allowMissingColumns=True)
    if known is not None:
        ids = known.select(F.col(conv_id).alias("conv"), F.lit(_CONVERSATION).alias("what")).distinct()
        stream = stream.unionByName(ids, allowMissingColumns=True)
    order = ["conv", F.col("what") != _CONVERSATION, "turn", "mark", "what", "place"]
    stream = stream.repartition("conv").sortWithinPartitions(*order)
    kind = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, turn long, edit string, role string, text string, fault string, illegal boolean"

    def edited(batches) -> Iterator[tuple]:
        """A decision follows the row that it is about."""
        conv, state, own, count = None, None, ("", ""), 0
        names = ("conv", "what", "turn", "role", "text", "edits", "fault", "illegal")
        for new, what, at, speaker, said, edits, fault, illegal in _each(batches, *names):
            if state is None or new != conv:
                if state is not None and not count:
                    yield conv, None, None, None, None, None, False
                conv, state, count = new, NOTHING, 0
            if what == _TURN:
                own = speaker, said
            elif what == _DECISION:
                count += 1
                for edit in edits:
                    if edit == "I":
                        state = NEXT[state]
                        yield conv, None, "I", ROLE[state], "", None, False
                        continue
                    name, words = own
                    if edit == "R":
                        state = NEXT[state]
                        name = ROLE[state]
                    elif edit == "K":
                        state = after(state, INITIALS.index(name[0]))
                    yield conv, at, edit, name, None if edit == "D" else words, fault, illegal
        if state is not None and not count:
            yield conv, None, None, None, None, None, False

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field("conv").type, pa.int64(), *[pa.string()] * 4, pa.bool_()]
        out = pa.schema(list(zip([f.split()[0] for f in schema.split(", ")], types, strict=True)))
        yield from _handed_on(edited(_chained(first, batches)), out, text=4)

    found = stream.mapInArrow(run, schema)
    names = {"conv": conv_id, "turn": turn, "role": role, "text": text}
    return found.withColumnsRenamed(names)


def _chained(first, rest):
    yield first
    yield from rest


def digests(
    edits: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Of what `repaired` returns, taken as it comes, a row for each conversation: `conv_id`, gaps (turns
    missing between the first and the last), blank, duplicate, truncated, illegal, cost, audit (the
    edits) and repaired_sha256 (of its lines `role:text`)."""
    kind = edits.schema[conv_id].dataType.simpleString()
    numbers = ["gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost"]
    schema = f"conv {kind}, {', '.join(f'{c} long' for c in numbers)}, audit string, repaired_sha256 string"
    cost = turn_blocks.COST

    def each(batches) -> Iterator[tuple]:
        conv, now = None, None
        for new, at, edit, speaker, said, fault, illegal in _each(
            batches, conv_id, turn, "edit", role, text, "fault", "illegal"
        ):
            if now is None or new != conv:
                if now is not None:
                    yield now.row(conv)
                conv, now = new, _Digest()
            if edit is None:
                continue
            if at is not None and at != now.last:
                now.first = at if now.first is None else now.first
                now.last, now.turns = at, now.turns + 1
            if fault:
                now.faults[fault] += 1
            now.illegal += illegal
            now.audit.append(edit)
            now.cost += cost[edit] + turn_blocks.TRUNCATED * (fault == TRUNCATED and edit != "D")
            if edit != "D":
                now.sha.update(f"{chr(10) if now.lines else ''}{speaker}:{said}".encode())
                now.lines += 1
        if now is not None:
            yield now.row(conv)

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field(conv_id).type, *[pa.int64()] * 6, *[pa.string()] * 2]
        out = pa.schema(list(zip([f.split()[0] for f in schema.split(", ")], types, strict=True)))
        yield from _handed_on(each(_chained(first, batches)), out, text=7)

    return edits.mapInArrow(run, schema).withColumnRenamed("conv", conv_id)


class _Digest:
    def __init__(self) -> None:
        self.first = self.last = None
        self.turns = self.illegal = self.cost = self.lines = 0
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0)
        self.audit: list[str] = []
        self.sha = hashlib.sha256()

    def row(self, conv: Any) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()
