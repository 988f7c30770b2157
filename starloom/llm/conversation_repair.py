"""Repair of conversations by cheapest edits, with a checkpointed dynamic programme.

A repaired conversation's role initials match ``(s?(ua)+)?``. Keeping a message costs 0,
giving it the role user or assistant 2, deleting it 3, inserting an empty message of
either role anywhere 2; a truncated message that is not deleted adds 1. Blank and
duplicate messages have to be deleted. Among the cheapest edits those whose initials
(D, I, K, R) are the ASCII-least are taken.

Between two messages one of four states holds: nothing yet, after s, u or a. The cost to
go is a vector of four numbers. Going backward only every ceil(sqrt(n))th vector is
stored; walking forward, the vectors of one piece are computed again from the
checkpoint at its end, and the least letter that stays on a cheapest way is taken.

Messages are put in order by one range-partitioned sort of short rows (no texts), so a
conversation that holds a large share of all rows is spread over many tasks. A
conversation of at most ``block`` messages is solved at once. A longer one is cut into
blocks of ceil(sqrt(n)), ``block`` at least. A block is a min-plus matrix of its four
states; the product of the matrices gives the checkpoints at the blocks' ends, every
block is walked from each state it can start in, and a chain of the states left says
which walk counts. Nothing per message but its letter is ever brought together.

Defined results: a null role or text counts as one space, a null conversation id as an
id of its own. Messages come by turn (null first), then by role, then by a hash of role
and text. Roles go by their first letter; one that is not s, u or a cannot be kept. Two
messages are equal if role and text have the same 128 bits of hash; among 10**12 texts
of a conversation two collide with a probability of about 10**-15. An empty table gives
empty tables. A text is one cell of any length. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.keys import in_global_order
from starloom.scratch import materialise

BLANKS = " \t\n\x0b\f\r"
#: Messages of a conversation that are solved at once.
BLOCK = 4096

#: States: nothing yet, after s, after u, after a. What a new role leads to, the cost of ending.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_FINAL = (0, 4, 2, 0)
_KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "x": (None,) * 4}
_FAR = 1 << 60


def _before(initial: str, fault: str, after: tuple) -> tuple:
    """The cost to go before a message, from the one after it."""
    own = [3 + cost for cost in after]
    if fault not in "bd":
        cut = fault == "t"
        for state, kept in enumerate(_KEEP[initial]):
            own[state] = min(own[state], 2 + cut + after[_NEXT[state]])
            if kept is not None:
                own[state] = min(own[state], cut + after[kept])
    # Two insertions at most: a third would lead to a state that was left.
    one = [min(own[s], 2 + own[_NEXT[s]]) for s in range(4)]
    return tuple(min(one[s], 2 + one[_NEXT[s]]) for s in range(4))


def _backward(initials: str, faults: str, end: tuple) -> tuple:
    """The cost to go at the start of a piece; nothing between is stored."""
    for initial, fault in zip(reversed(initials), reversed(faults), strict=True):
        end = _before(initial, fault, end)
    return end


def _walk(initials: str, faults: str, end: tuple, state: int) -> tuple[str, int]:
    """The least cheapest edits of one piece, and the state after it."""
    vectors = [end]
    for initial, fault in zip(reversed(initials), reversed(faults), strict=True):
        vectors.append(_before(initial, fault, vectors[-1]))
    vectors.reverse()
    out = []
    for i, (initial, fault) in enumerate(zip(initials, faults, strict=True)):
        now, after = vectors[i], vectors[i + 1]
        while 3 + after[state] != now[state] and 2 + now[_NEXT[state]] == now[state]:
            out.append("I")
            state = _NEXT[state]
        kept = _KEEP[initial][state]
        if 3 + after[state] == now[state]:
            out.append("D")
        elif kept is not None and (fault == "t") + after[kept] == now[state]:
            out.append("K")
            state = kept
        else:
            out.append("R")
            state = _NEXT[state]
    return "".join(out), state


def _finish(state: int) -> str:
    return "I" * (_FINAL[state] // 2)


def _walk_checkpointed(initials: str, faults: str, end: tuple, state: int) -> tuple[str, int]:
    """The walk over any number of messages with about 2 * sqrt(n) vectors in memory."""
    n = len(initials)
    step = isqrt(max(n - 1, 0)) + 1
    starts = range(0, n, step)
    checkpoints = [end]
    for start in reversed(starts[1:]):
        checkpoints.append(_backward(initials[start : start + step], faults[start : start + step], checkpoints[-1]))
    out = []
    for start in starts:
        edits, state = _walk(initials[start : start + step], faults[start : start + step], checkpoints.pop(), state)
        out.append(edits)
    return "".join(out), state


@lru_cache(maxsize=100_000)
def least_edits(initials: str, faults: str) -> tuple[int, str]:
    """(cost, edits) of a whole conversation: role initials (x for others) and faults b, d, t or -."""
    edits, state = _walk_checkpointed(initials, faults, _FINAL, 0)
    return _backward(initials, faults, _FINAL)[0], edits + _finish(state)


def _illegal(initials: str, following: str) -> int:
    line = initials + following
    return sum(line[i : i + 2] not in ("su", "ua", "au") for i in range(len(line) - 1))


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations: (key, block, initials, faults, next, count) -> their edits."""
    for batch in batches:
        rows = [(least_edits(r["initials"], r["faults"]), _illegal(r["initials"], r["following"])) for r in batch.to_pylist()]
        columns = ([0] * len(rows), [r[0][1] for r in rows], [r[0][0] for r in rows], [r[1] for r in rows])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True))],
            names=["key", "block", "start", "edits", "cost", "illegal"],
        )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the cost from each state at its start (rows) to each at its end."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            ends = [_backward(r["initials"], r["faults"], tuple(0 if s == e else _FAR for s in range(4))) for e in range(4)]
            out.append([ends[e][s] for s in range(4) for e in range(4)])
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.list_(pa.int64()))], names=["key", "block", "matrix"])


def _checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation the cost to go at the end of every block, and the whole cost."""
    for batch in batches:
        out: list[tuple] = []
        for r in batch.to_pylist():
            after, found = _FINAL, []
            for part in reversed(r["parts"]):
                found.append((r["key"], part["block"], list(after)))
                rows = (part["matrix"][4 * s : 4 * s + 4] for s in range(4))
                after = tuple(min(a + b for a, b in zip(row, after, strict=True)) for row in rows)
            out += [(*f, after[0]) for f in found]
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "block", "end", "cost"])


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block its edits and last state for each state it may start in."""
    for batch in batches:
        walks = [[_walk_checkpointed(r["initials"], r["faults"], tuple(r["end"]), s) for s in range(4)] for r in batch.to_pylist()]
        illegal = [_illegal(r["initials"], r["following"]) for r in batch.to_pylist()]
        columns = ([[w[0] for w in x] for x in walks], [[w[1] for w in x] for x in walks], illegal)
        kinds = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], batch.column(batch.schema.get_field_index("cost")), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            names=["key", "block", "cost", "walks", "exits", "illegal"],
        )


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation the state in which each block starts; the last block's exit decides what is inserted."""
    for batch in batches:
        out: list[tuple] = []
        for r in batch.to_pylist():
            state = 0
            for k, part in enumerate(r["parts"]):
                exit_ = part["exits"][state]
                out.append((r["key"], part["block"], state, _finish(exit_) if k == len(r["parts"]) - 1 else ""))
                state = exit_
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "block", "start", "tail"])


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The messages that stay, in order: what they are made of, and their new role."""
    names = ("key", "block", "step", "h1", "h2", "edit", "role")
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
    for batch in batches:
        out: list[tuple] = []
        for r in batch.to_pylist():
            state, place = r["start"], 0
            for step, edit in enumerate(r["edits"]):
                own = (None, None)
                if edit != "I":
                    own = (r["hashes"][place]["h1"], r["hashes"][place]["h2"])
                    place += 1
                if edit == "D":
                    continue
                out.append((r["key"], r["block"], step, *own, edit, None if edit == "K" else _ROLE[state]))
                state = _KEEP[r["initials"][place - 1]][state] if edit == "K" else _NEXT[state]
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))


@dataclass(frozen=True)
class Repaired:
    """``messages``: key, block, step (their order), edit, role, text of all that remain.

    ``summary``, one row per conversation with messages: key, id, gaps, blank, duplicate,
    truncated, illegal, cost, audit.
    """

    messages: DataFrame
    summary: DataFrame


def conversation_key(column: str) -> Column:
    """The id as text, one space for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame, *, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """Messages with planted faults, chosen by a checksum of id and turn (one space for null):
    dropped, emptied, without stops, repeated, or of the role user. Null roles and texts become one space."""
    chosen = F.crc32(F.concat(conversation_key(id_column), F.lit(":"), conversation_key(turn_column))) % 20
    named = rows.select(
        F.col(id_column).alias("conv_id"),
        F.col(turn_column).alias("turn"),
        F.coalesce(role_column, F.lit(" ")).alias("role"),
        F.coalesce(text_column, F.lit(" ")).alias("text"),
        chosen.alias("fault"),
    ).where(F.col("fault") != 0)
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return named.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repair_conversations(
    rows: DataFrame,
    *,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    block: int = BLOCK,
) -> Repaired:
    """The repaired messages of all conversations, and what was wrong with each."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role_column, text_column))
    named = rows.select(
        conversation_key(id_column).alias("key"), F.col(id_column).alias("id"), F.col(turn_column).alias("turn"), role.alias("role"), text.alias("text")
    )
    named = named.select("*", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"))
    marked = _marked(named)
    blocks = materialise(_blocks(marked, block), "conversation-blocks")

    solved = _solved(blocks)
    steps = solved.join(blocks.select("key", "block", "initials", "hashes"), ["key", "block"])
    steps = steps.select("key", "block", "start", "edits", "initials", "hashes").mapInArrow(
        _steps, "key string, block long, step long, h1 long, h2 long, edit string, role string"
    )
    # Duplicates are deleted, so one text stands for a hash in a conversation.
    texts = named.groupBy("key", "h1", "h2").agg(F.min(F.struct("role", "text")).alias("own"))
    messages = steps.join(texts, ["key", "h1", "h2"], "left").select(
        "key", "block", "step", "edit", F.coalesce("role", "own.role").alias("role"), F.coalesce("own.text", F.lit("")).alias("text")
    )

    per_block = F.sort_array(F.collect_list(F.struct("block", "edits")))
    audits = solved.groupBy("key").agg(
        F.sum("illegal").alias("illegal"), F.max("cost").alias("cost"), F.array_join(F.transform(per_block, lambda x: x["edits"]), "").alias("audit")
    )
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    fault = lambda letter, name: F.count_if(F.col("fault") == letter).alias(name)
    found = marked.groupBy("key").agg(
        F.min("id").alias("id"),
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"),
        fault("b", "blank"),
        fault("d", "duplicate"),
        fault("t", "truncated"),
    )
    return Repaired(messages, found.join(audits, "key"))


def _marked(named: DataFrame) -> DataFrame:
    """key, id, turn, initial, fault, h1, h2, place (from 0 in its conversation) and total, as a written table."""
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    short = named.select(
        "key",
        "id",
        "turn",
        "role",
        "h1",
        "h2",
        F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x").alias("initial"),
        (stripped == "").alias("blank"),
        F.right(stripped, F.lit(1)).isin(".", "!", "?").alias("ended"),
    )
    ordered = in_global_order(short, ["key", "turn", "role", "h1", "h2"], "conversation-order")
    table, part, pos = ordered.table, ordered.part, ordered.pos
    # The first of equal messages; a message repeated without end is one row per task here.
    first = table.groupBy("key", "h1", "h2").agg(F.min(F.struct(part, pos)).alias("at")).select(f"at.{part}", f"at.{pos}", F.lit(True).alias("first"))
    # A conversation's share of each partition: one row per partition it reaches into.
    pieces = table.groupBy("key", part).agg(F.count("*").alias("n"), F.min(pos).alias("low"))
    own = Window.partitionBy("key")
    earlier = own.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("key", part, "low", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(own).alias("total"))
    joined = table.join(first, [part, pos], "left").join(pieces, ["key", part])
    fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(~F.col("ended"), "t").otherwise("-")
    place = F.col("before") + F.col(pos) - F.col("low")
    return materialise(joined.select("key", "id", "turn", "initial", fault.alias("fault"), "h1", "h2", place.alias("place"), "total"), "conversation-rows")


def _blocks(marked: DataFrame, block: int) -> DataFrame:
    """One row per block: key, block, blocks, initials, faults, hashes, and the initial that follows."""
    length = F.greatest(F.lit(block), F.ceil(F.sqrt(F.col("total").cast("double")))).cast("long")
    placed = marked.withColumn("block", F.floor(F.col("place") / length)).withColumn("blocks", F.ceil(F.col("total") / length))
    rows = F.sort_array(F.collect_list(F.struct("place", "initial", "fault", "h1", "h2")))
    found = placed.groupBy("key", "block", "blocks").agg(rows.alias("rows"))
    letters = lambda name: F.array_join(F.transform("rows", lambda x: x[name]), "").alias(name + "s")
    hashes = F.transform("rows", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"))).alias("hashes")
    lettered = found.select("key", "block", "blocks", letters("initial"), letters("fault"), hashes)
    following = F.lead(F.substring("initials", 1, 1)).over(Window.partitionBy("key").orderBy("block"))
    return lettered.withColumn("following", F.coalesce(following, F.lit("")))


def _solved(blocks: DataFrame) -> DataFrame:
    """Per block: key, block, start (the state before it), edits, the conversation's cost, illegal pairs."""
    given = blocks.select("key", "block", "blocks", "initials", "faults", "following")
    whole = given.where("blocks = 1").drop("blocks")
    schema = "key string, block long, start int, edits string, cost long, illegal long"
    solved = materialise(whole.mapInArrow(_solve, schema), "conversation-edits")
    cut = given.where("blocks > 1").drop("blocks")
    if cut.isEmpty():
        return solved
    parts = lambda *names: F.sort_array(F.collect_list(F.struct("block", *names))).alias("parts")
    matrices = cut.mapInArrow(_matrices, "key string, block long, matrix array<long>")
    ends = matrices.groupBy("key").agg(parts("matrix")).mapInArrow(_checkpoints, "key string, block long, end array<long>, cost long")
    walks = cut.join(ends, ["key", "block"]).mapInArrow(
        _walks, "key string, block long, cost long, walks array<string>, exits array<int>, illegal long"
    )
    walks = materialise(walks, "conversation-walks")
    starts = walks.groupBy("key").agg(parts("exits")).mapInArrow(_starts, "key string, block long, start int, tail string")
    chosen = walks.join(starts, ["key", "block"]).select(
        "key", "block", "start", F.concat(F.get("walks", F.col("start")), "tail").alias("edits"), "cost", "illegal"
    )
    return solved.unionByName(materialise(chosen, "conversation-edits"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, from rows in order; texts pass by one at a time."""
    last, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != last:
                if last is not None:
                    done.append((last, digest.hexdigest()))
                last, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(line.encode())
        yield _pairs(done)
    if last is not None:
        yield _pairs([(last, digest.hexdigest())])


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], names=["key", "sha256"])


def message_digests(messages: DataFrame) -> DataFrame:
    """(key, sha256) of ``role:text`` of the messages, joined by newlines.

    A checksum of one text is sequential, so each conversation passes through one task
    here, message by message; no more than a batch of it is in memory.
    """
    tasks = max(1, int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = messages.repartition(tasks, "key").sortWithinPartitions("key", "block", "step")
    lines = dealt.select("key", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.mapInArrow(_digests, "key string, sha256 string")
