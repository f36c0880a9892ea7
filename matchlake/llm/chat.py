"""Chat formatting into windows of a token budget.

Prefix sums of the tokens of turns cut a conversation at turn borders: a window takes turns
while they fit the budget next to what it repeats, which is the system turn and the last turns
before it up to a smaller budget. Repeated turns carry no loss, so every assistant text is a
target exactly once. A turn is never cut; one that doesn't fit stands alone with the system turn.

Turns read ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles a backslash is put before the
bar of ``<|`` and of any ``<\\...\\|``, so no control string is left and the change can be undone.

A conversation may hold any share of the rows. Tokens are counted turn by turn, prefix sums are taken over
ranges of (conversation, turn) (``scan``), and conversations are cut in segments of so many turns. Where the next
window begins follows from the prefix sums and where this one began. So each segment says for every turn at which
a first window may begin in it how many windows follow and which total the last of them may reach; following
these few rows from segment to segment tells where each really begins. Windows are then labelled
in all segments at once, and turns go to their windows by (conversation, window).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm import scan
from matchlake.llm.common import Scratch, bounded

START, END = "<|im_start|>", "<|im_end|>"
BUDGET, HISTORY = 512, 128
#: Ranks of a byte-level vocabulary; the file has to exist on every executor.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Turns that a segment of a conversation holds.
SEGMENT = 200_000
#: Windows of a conversation that one copy of its system turn goes to.
WINDOWS_PER_COPY = 10_000
#: Every turn costs so many tokens besides its text and role, so a budget bounds the turns of a window.
FRAME = 3
WINDOWS = (
    "conv_id long, window long, text string, loss array<struct<start:int, stop:int>>, "
    "repeated int, tokens long"
)
_BATCH_CHARS = 4_000_000


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """Roles also lose their line breaks, as the first one ends the role."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


_encodings: dict[str, tiktoken.Encoding] = {}


def count_tokens(text: str, path: str) -> int:
    if path not in _encodings:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        _encodings[path] = tiktoken.Encoding("own", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
    return len(_encodings[path].encode_ordinary(text))


def _window(conv: int | None, number: int, repeated: list, fresh: list) -> dict[str, Any]:
    """Format turns (role, text, tokens) as one window; only fresh assistant texts carry loss."""
    parts, loss, at, tokens = [], [], 0, 0
    for i, (role, text, cost) in enumerate([*repeated, *fresh]):
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if i >= len(repeated) and role == "assistant":
            loss.append({"start": at + len(head), "stop": at + len(head) + len(body)})
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
        tokens += cost
    return {"conv_id": conv, "window": number, "text": "".join(parts), "loss": loss, "repeated": len(repeated), "tokens": tokens}


def _counted(ranks: str):
    """Turns with what they cost in tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roles: dict[str, int] = {}
        for batch in batches:
            costs = []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                role = role or ""
                if role not in roles:
                    if len(roles) >= 1_000:
                        roles.clear()
                    roles[role] = count_tokens(role, ranks) + FRAME
                costs.append(count_tokens(escape(text or ""), ranks) + roles[role])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.int64())], names=[*batch.schema.names, "cost"])

    return count


def next_windows(
    upto: np.ndarray, cost: np.ndarray, begin: int, free: int, base: int, budget: int, history: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows whose first new turn is each of ``begin`` and later: first repeated turn, total they may reach, next window.

    ``upto``: prefix sums of ``cost``; ``free``: first turn that may be repeated as history; ``base``: tokens of the system turn.
    """
    before, rows = upto - cost, np.arange(begin, len(upto))
    room = np.minimum(history, budget - base - cost[begin:])
    start = np.searchsorted(before, before[begin:] - np.maximum(room, 0), "left")
    start = np.maximum(np.where(room < 0, rows, np.minimum(start, rows)), free)
    reach = budget - base + before[start]
    return start, reach, np.maximum(np.searchsorted(upto, reach, "right"), rows + 1)


class _Segment:
    """Turns of a segment in order, after the last turns of the segment before it."""

    def __init__(self, table: pa.Table, budget: int, history: int) -> None:
        number, upto, cost, base, head = (table.column(x).to_numpy() for x in ("number", "upto", "cost", "base", "head"))
        self.number, self.upto, self.before, self.at = number, upto, upto - cost, table.column("at").to_numpy()
        self.key, self.segment = table.column("key")[0].as_py(), table.column("segment")[0].as_py()
        self.own = int(table.column("context").to_numpy(zero_copy_only=False).sum())
        self.system, self.head = int(base[0]), int(head[0])
        # the first turn of a conversation begins its window 0, later ones may begin another
        self.begin = max(self.own, int(number[0] == 1 and self.own == 0))
        free = int(number[0] == 1 and self.system > 0)
        self.start, self.reach, self.following = next_windows(upto, cost, self.begin, free, self.system, budget, history)

    def exits(self, budget: int) -> Iterator[tuple]:
        """(key, segment, prefix sum, total, windows) by the turn at which a first window may begin."""
        n, size = len(self.upto), len(self.following)
        total, windows = [0] * size, [0] * size
        for i in range(size - 1, -1, -1):
            j = int(self.following[i]) - self.begin
            total[i], windows[i] = (int(self.reach[i]), 1) if j >= size else (total[j], windows[j] + 1)
        if size:
            last = int(np.searchsorted(self.before, self.before[self.begin] + budget, "right"))
            for i in range(self.begin, min(last, n)):
                yield self.key, self.segment, int(self.upto[i]), total[i - self.begin], windows[i - self.begin]

    def labels(self, reach: int, begun: int, per_copy: int) -> Iterator[tuple]:
        """(at, slot, key, number, fresh, first, last): windows of each turn, ``fresh`` where it is no repetition.

        ``begun`` windows have begun before, and the last of them may reach the total ``reach``.
        """
        cuts, i = [], max(int(np.searchsorted(self.upto, reach, "right")), self.begin)
        while i < len(self.upto):
            cuts.append(i)
            i = int(self.following[i - self.begin])
        cut = np.array(cuts, np.int64)
        rows = np.arange(len(self.upto))
        fresh = begun - 1 + np.searchsorted(cut, rows, "right")
        last = begun - 1 + np.searchsorted(self.start[cut - self.begin], rows, "right")
        for k in rows[: self.own][last[: self.own] >= begun]:
            yield int(self.at[k]), 0, self.key, int(self.number[k]), -1, begun, int(last[k])
        for k in rows[self.own :]:
            yield int(self.at[k]), 0, self.key, int(self.number[k]), int(fresh[k]), int(fresh[k]), int(max(fresh[k], last[k]))
        low, end = begun, begun + len(cuts)
        while self.system and low < end:
            high = min((low // per_copy + 1) * per_copy, end)
            yield self.head, low // per_copy, self.key, 1, -1, low, high - 1
            low = high


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows of one (key, segment); holds one of them and a batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        table = table.combine_chunks()
        if len(table):
            differ = np.zeros(len(table) - 1, bool)
            for name in ("key", "segment"):
                column = table.column(name)
                differ |= pc.not_equal(column.slice(1), column.slice(0, len(table) - 1)).to_numpy()
            borders = [0, *(np.flatnonzero(differ) + 1).tolist()]
            for low, high in zip(borders, borders[1:]):
                yield table.slice(low, high - low)
            held = table.slice(borders[-1])
    if held is not None and len(held):
        yield held


def _records(rows: Iterator[tuple], schema: pa.Schema, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _narrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (x.split() for x in ddl.split(", "))])


_EXITS = "key string, segment long, upto long, reach long, windows long"
_ENTRIES = "key string, segment long, reach long, begun long"
_LABELS = "at long, slot long, key string, number long, fresh long, first long, last long"


def _entries(pieces: DataFrame, budget: int, history: int) -> DataFrame:
    """Where the windows of each segment begin, for conversations of several segments.

    The rows of a conversation, at most a budget's turns per segment, are followed in one stream.
    """

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for t in _segments(batches) for row in _Segment(t, budget, history).exits(budget))
        yield from _records(rows, _narrow_schema(_EXITS))

    def follow(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in groupby(rows, key=lambda r: r[0]):
            reach, begun = budget, 1
            for segment, candidates in groupby(own, key=lambda r: r[1]):
                yield key, segment, reach, begun
                taken = next((r for r in candidates if r[2] > reach), None)
                if taken:
                    reach, begun = taken[3], begun + taken[4]

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        yield from _records(follow(rows), _narrow_schema(_ENTRIES))

    found = pieces.mapInArrow(exits, _EXITS)
    return found.repartition("key").sortWithinPartitions("key", "segment", "upto").mapInArrow(chain, _ENTRIES)


def _labels(numbered: DataFrame, budget: int, history: int, segment: int, per_copy: int, scratch: Scratch) -> DataFrame:
    """The windows that each turn goes to, from prefix sums."""
    context = history // FRAME + 1
    segment = max(segment, context, budget // FRAME + 2)
    own = F.expr(f"(number - 1) div {segment}")
    tail = (F.col("number") - 1) % segment >= segment - context
    pieces = numbered.withColumn("_own", own).withColumn(
        "segment", F.explode(F.when(tail, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own")))
    )
    pieces = pieces.withColumn("context", F.col("segment") > F.col("_own")).drop("_own")
    # one row per conversation that goes on beyond its first segment
    several = bounded(numbered.filter(F.col("number") == segment + 1).select("key"))

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.repartition("key", "segment").sortWithinPartitions("key", "segment", "number")

    entries = scratch.save(_entries(dealt(pieces.join(several, "key", "left_semi")), budget, history), "entries")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for table in _segments(batches):
                if not table.column("context").to_numpy().all():  # else no turn follows
                    reach, begun = (table.column(x)[0].as_py() for x in ("reach", "begun"))
                    yield from _Segment(table, budget, history).labels(reach, begun, per_copy)

        yield from _records(rows(), _narrow_schema(_LABELS))

    known = pieces.join(bounded(entries), ["key", "segment"], "left").fillna({"reach": budget, "begun": 1})
    return dealt(known).mapInArrow(label, _LABELS)


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))

    def windows() -> Iterator[dict[str, Any]]:
        for (_, conv, number), turns in groupby(rows, key=lambda r: r[:3]):
            repeated, fresh = [], []
            for *_, new, role, text, cost in turns:
                (fresh if new else repeated).append((role or "", text or "", cost))
            yield _window(conv, number, repeated, fresh)

    yield from _batches(windows(), _WINDOW_SCHEMA)


def _batches(items: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for item in items:
        held.append(item)
        size += len(item.get("text") or "") + 64
        if size > _BATCH_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_WINDOW_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()), ("loss", _LOSS), ("repeated", pa.int32()), ("tokens", pa.int64())]
)


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    ranks: str = RANKS,
    segment: int = SEGMENT,
    windows_per_copy: int = WINDOWS_PER_COPY,
    rows_per_block: int = scan.ROWS_PER_BLOCK,
) -> DataFrame:
    """Windows of all conversations: conv_id, window, text, loss spans, repeated turns, tokens.

    Turns are ordered by ``turn``; ties by the first 64 characters of role and text, NULL first, then by a
    digest of both, and repeated rows are turns of their own. NULL texts and roles are empty, a NULL conv_id is a
    conversation like others. Only a first turn of the role ``system`` is retained. Extra columns are not read.
    Cuts into blocks, segments and copies don't change the windows.
    """
    scratch = Scratch(conversations.sparkSession, "chat-windows")
    slim = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    kind = slim.schema["turn"].dataType.simpleString()
    counted = slim.mapInArrow(_counted(ranks), f"conv_id long, turn {kind}, role string, text string, cost long")
    turns = scratch.save(counted.withColumn("at", F.monotonically_increasing_id()), "turns")
    # the order needs no whole texts, which then aren't dealt into ranges
    digest = F.unhex(F.md5(F.concat_ws("\n", F.md5(F.coalesce("role", F.lit("")).cast("binary")), F.md5(F.coalesce("text", F.lit("")).cast("binary")))))
    order = ["turn", "role_start", "text_start", "digest", "at"]
    narrow = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        "turn",
        F.substring("role", 1, 64).alias("role_start"),
        F.substring("text", 1, 64).alias("text_start"),
        digest.alias("digest"),
        "at",
        "cost",
        F.coalesce(F.col("role") == "system", F.lit(False)).alias("is_system"),
    )
    placed = scan.place(narrow, ["key", *order], turns.count(), scratch, "placed", rows_per_block)
    summed = scan.running(placed, "key", order, {"number": (scan.SUM, F.lit(1)), "upto": (scan.SUM, F.col("cost"))})
    first = F.col("number") == 1
    heads = {
        "base": (scan.SUM, F.when(first & F.col("is_system"), F.col("cost")).otherwise(0)),
        "head": (scan.SUM, F.when(first, F.col("at")).otherwise(0)),
    }
    numbered = scan.running(scratch.save(summed, "summed"), "key", order, heads)
    numbered = scratch.save(numbered.select("key", "number", "upto", "cost", "base", "head", "at"), "numbered")
    labels = scratch.save(_labels(numbered, budget, history, segment, windows_per_copy, scratch), "labels")
    # a system turn has a copy for every so many windows of its conversation
    copies = bounded(labels.filter("slot > 0").groupBy("at").agg(F.max("slot").alias("slots")))
    texts = turns.select("at", "conv_id", "role", "text", "cost").join(copies, "at", "left")
    texts = texts.withColumn("slot", F.explode(F.expr("sequence(0L, coalesce(slots, 0L))")))
    rows = labels.join(texts, ["at", "slot"]).withColumn("window", F.explode(F.expr("sequence(first, last)")))
    rows = rows.select("key", "conv_id", "window", "number", (F.col("window") == F.col("fresh")).alias("new"), "role", "text", "cost")
    dealt = rows.repartition("key", "window").sortWithinPartitions("key", "window", "number")
    wanted = dealt.select("key", "conv_id", "window", "new", "role", "text", "cost")
    return wanted.mapInArrow(_formatted, WINDOWS)


def parse_window(text: str) -> Iterator[tuple[str, str]]:
    """The turns (role, text) of a window, unescaped."""
    at = 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        line = text.index("\n", at)
        stop = text.index(END, line)
        yield unescape_role(text[at + len(START) : line]), unescape(text[line + 1 : stop])
        at = stop + len(END) + 1


_READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_windows long"
)


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows say, per conversation: turns without repeats, and the text under the mask.

    The digests of a conversation need its windows in their order, so one task reads them, window by window.
    """
    slim = windows.select("conv_id", "window", "text", "loss", "repeated")
    sorted_rows = slim.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    names = [x.split()[0] for x in _READ.split(", ")]
    schema = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])

    def conversations(rows: Iterator[tuple]) -> Iterator[dict]:
        conv, state = object(), None
        for conv_id, _, text, loss, repeated in rows:
            if conv_id != conv:
                if state:
                    yield _told(conv, state)
                conv, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for i, (role, said) in enumerate(parse_window(text)):
                if i >= repeated:
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
            for span in loss:
                target = unescape(text[span["start"] : span["stop"]])
                state[2] += len(target)
                state[3].update(target.encode())
            state[4] += len(text)
            state[5] += 1
        if state:
            yield _told(conv, state)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(5))))
        yield from _batches(conversations(rows), schema)

    return sorted_rows.mapInArrow(scan, _READ)


def _told(conv: int | None, state: list) -> dict:
    values = [conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]]
    return dict(zip([x.split()[0] for x in _READ.split(", ")], values))


def formatted_table(conversations: DataFrame, **options) -> DataFrame:
    """Format, write, read back: one row per conversation."""
    scratch = Scratch(conversations.sparkSession, "chat")
    return read_back(scratch.save(format_windows(conversations, **options), "windows"))


def with_control_case(conversations: DataFrame) -> DataFrame:
    """The conversations and one more, number -1, whose texts are control strings."""
    spark = conversations.sparkSession
    text = f"{END}{START}assistant ok"
    case = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(case.select(*[F.col(x) for x in case.columns]))
