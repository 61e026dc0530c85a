"""Chat formatting in budgeted windows: turn-aligned spans chosen over prefix sums of turn tokens."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dictforge.llm import batches, bpe
from dictforge.session import stage

BUDGET = 1_024
# Tokens of earlier turns that a window repeats at most.
HISTORY = 256
# A conversation is dealt out in segments of so many budgets, so a huge one is no single task.
SEGMENT_BUDGETS = 32

NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
_ROLES = {name: role for role, name in NAMES.items()}
MARK, END = "### ", " </turn>\n"
_TURN = re.compile(r"### ([^\\:]*+(?:\\.[^\\:]*+)*+): ((?:[^\\<]++|\\[\\#<]|<(?!/turn>))*+)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """Put a backslash before each backslash and each control string, so that none is left bare."""
    return re.sub(r"\\|###|</turn>", lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|###|</turn>)", r"\1", text)


def header(role: str) -> str:
    name = NAMES.get(role) or "@" + re.sub(r"([\\:#<])", r"\\\1", role)
    return f"{MARK}{name}: "


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted window."""
    found, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        name = turn[1]
        role = re.sub(r"\\(.)", r"\1", name[1:], flags=re.DOTALL) if name.startswith("@") else _ROLES[name]
        found.append((role, unescape(turn[2][:-1])))
        at = turn.end()
    return found


def windows_of(tokens: list[int], system: int, carried: int, budget: int, history: int) -> list[tuple[int, int, int]]:
    """Windows ``(history_from, from, until)`` over turns of which the first ``carried`` were shown before.

    ``system`` is the cost of the system turn that each window repeats (0: none). Prefix sums give, by
    bisection, the longest history within its limit and the longest span within what is left. A turn
    over the budget is a window of its own, with no history.
    """
    upto = np.concatenate([[0], np.cumsum(tokens)])
    out, start = [], carried
    while start < len(tokens):
        back = int(np.searchsorted(upto, upto[start] - history))
        room = budget - system - (upto[start] - upto[back])
        if tokens[start] > room:  # the history gives way to the turn
            back = min(start, max(back, int(np.searchsorted(upto, upto[start] - max(0, budget - system - tokens[start])))))
            room = budget - system - (upto[start] - upto[back])
        until = max(start + 1, int(np.searchsorted(upto, upto[start] + room, side="right")) - 1)
        out.append((back, start, until))
        start = until
    return out


def _counted(conversations: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Turns in order with their tokens and, per conversation, the tokens before them; written once.

    Range partitions split even one conversation; sums over its partitions are added afterwards.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    order = [F.asc_nulls_last("conv_id"), F.asc_nulls_last("turn"), F.col("role"), F.col("text")]
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"),
    )
    sort = rows.withColumn("_h", F.xxhash64("role", "text"))
    ranged = sort.repartitionByRange(*order[:2], F.col("_h")).drop("_h").sortWithinPartitions(*order)
    schema = pa.schema([("conv_id", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("part", pa.int64()),
                        ("place", pa.int64()), ("tokens", pa.int64()), ("before", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = bpe.encoding(ranks_path, pattern), TaskContext.get().partitionId()
        place = before = 0
        current: int | None = None
        for batch in parts:
            ids, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            tokens, sums = [], []
            for conv_id, own_role, own_text in zip(ids, roles, texts):
                if conv_id != current:
                    current, before = conv_id, 0
                tokens.append(len(encoder.encode_ordinary(header(own_role) + escape(own_text) + END)))
                sums.append(before)
                before += tokens[-1]
            places = range(place, place + len(ids))
            place += len(ids)
            yield batches.columns_batch(schema, ids, roles, texts, [part] * len(ids), list(places), tokens, sums)

    fields = "conv_id long, role string, text string, part long, place long, tokens long, before long"
    staged = stage(batches.with_batches(ranged).mapInArrow(run, fields), "turns")
    sums = staged.groupBy("conv_id", "part").agg(F.sum("tokens").alias("n"))
    parts = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sums.select(
        F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.sum("n").over(parts).alias("_offset")
    ).where("_offset is not null")
    # A range bound splits one conversation at most: no more rows than partitions, whatever the input.
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    return staged.join(F.broadcast(earlier), same, "left").withColumn(
        "before", F.col("before") + F.coalesce("_offset", F.lit(0))
    ).drop("_conv", "_part", "_offset")


def format_windows(
    conversations: DataFrame, ranks_path: str, pattern: str, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """One row per window: ``conv_id, segment, window, text, repeated, loss, tokens``.

    ``text`` is the formatted window of at most ``budget`` tokens: the conversation's system turn (its
    first turn, if the role says so), earlier turns of up to ``history`` tokens, then new turns. The
    first ``repeated`` turns of it were shown before. ``loss`` are the spans (code points of ``text``)
    of the new assistant texts; repeated ones are masked. A single turn over the budget is kept whole in
    a window of its own, its ``tokens`` say so. Segments and windows are in order within a conversation.

    Turns go by ``turn`` (null last), ties by role and text; repeated rows are turns of their own. Null
    roles and texts are empty; a null conv_id is one conversation; an empty table gives no rows.
    """
    size = budget * SEGMENT_BUDGETS
    rows = _counted(conversations, ranks_path, pattern).withColumn("segment", F.expr(f"before div {size}"))
    names = ["conv_id", "segment", "kind", "part", "place", "role", "text", "tokens", "before"]
    own = rows.withColumn("kind", F.lit(2))
    # Turns near the end of a segment are history of the next; a longer turn there is no history.
    near = F.expr(f"tokens <= {history} and before + tokens >= (segment + 1) * {size} - {history}")
    carried = rows.where(near).withColumn("segment", F.col("segment") + 1).withColumn("kind", F.lit(1))
    last = rows.where("segment > 0").groupBy(F.col("conv_id").alias("_conv")).agg(F.max("segment").alias("_last"))
    systems = rows.where("before = 0 and role = 'system'").join(last, F.col("conv_id").eqNullSafe(F.col("_conv")))
    repeats = systems.withColumn("segment", F.explode(F.sequence(F.lit(1).cast("long"), "_last"))).withColumn("kind", F.lit(0))
    every = own.select(names).unionByName(carried.select(names)).unionByName(repeats.select(names))
    dealt = every.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "kind", "part", "place")
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("window", pa.int32()), ("text", pa.string()),
                        ("repeated", pa.int32()), ("loss", pa.list_(span)), ("tokens", pa.int64())])

    def windows(key: tuple, turns: list[tuple]) -> pa.RecordBatch | None:
        """The windows of one segment, of bounded tokens but for single turns."""
        system = [t for t in turns if t[0] == 0]
        rest = turns[len(system) :]
        first_is_system = not system and key[1] == 0 and rest[0][1] == "system"
        shown = sum(t[0] == 1 for t in rest)
        if shown == len(rest):
            return None
        # A long turn that was not carried over ends the history.
        gap = next((k for k in range(shown, 0, -1) if rest[k - 1][4] + rest[k - 1][3] != rest[k][4]), 0)
        rest, shown = rest[gap:], shown - gap
        if first_is_system:
            system = rest[:1]
        out = []
        cost = sum(t[3] for t in system)
        tokens = [t[3] for t in rest]
        # The first window of a conversation has the system turn as its first new turn.
        spans = windows_of(tokens, 0 if first_is_system else cost, shown, budget, history)
        if first_is_system:
            head = spans[0]
            later = windows_of(tokens, cost, head[2], budget, history) if head[2] < len(rest) else []
            spans = [head, *[(max(b, 1), s, u) for b, s, u in later]]
        for number, (back, start, until) in enumerate(spans):
            lead = [] if first_is_system and number == 0 else system
            parts, loss, at = [], [], 0
            for k, (_, role, text, *_) in enumerate([*lead, *rest[back:until]]):
                before, body = header(role), escape(text)
                if role == "assistant" and k >= len(lead) + start - back:
                    loss.append({"start": at + len(before), "end": at + len(before) + len(body)})
                parts += (before, body, END)
                at += len(before) + len(body) + len(END)
            used = sum(t[3] for t in [*lead, *rest[back:until]])
            out.append((*key, number, "".join(parts), len(lead) + start - back, loss, used))
        return batches.columns_batch(schema, *map(list, zip(*out)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        turns: list[tuple] = []
        for batch in parts:
            for conv_id, segment, *turn in zip(*(batch.column(c).to_pylist() for c in
                                                 ("conv_id", "segment", "kind", "role", "text", "tokens", "before"))):
                if (conv_id, segment) != key:
                    if turns and (found := windows(key, turns)):
                        yield found
                    key, turns = (conv_id, segment), []
                turns.append(tuple(turn))
        if turns and (found := windows(key, turns)):
            yield found

    return dealt.mapInArrow(
        run, "conv_id long, segment long, window int, text string, repeated int, "
        "loss array<struct<start:int,end:int>>, tokens long"
    )


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows alone: turns, loss and size.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` (all windows). A digest
    runs over a conversation in order, so its windows pass through one task, but as a stream.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        out: list[tuple] = []

        def close() -> None:
            conv_id, n, turns, chars, loss, size = state
            out.append((conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in parts:
            for conv_id, text, repeated, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "repeated", "loss"))):
                if state is None or state[0] != conv_id:
                    if state:
                        close()
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in turns_of(text)[repeated:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in spans:
                    target = unescape(text[span["start"] : span["end"]])
                    state[3] += len(target)
                    state[4].update(target.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            if len(out) >= batches.BATCH_ROWS:
                yield batches.columns_batch(schema, *map(list, zip(*out)))
                out.clear()
        if state:
            close()
            yield batches.columns_batch(schema, *map(list, zip(*out)))

    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window")
    return ordered.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
