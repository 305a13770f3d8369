r"""Chat formatting as prefix trees: turns that conversations share are emitted once.

A turn is written ``### Role: text</turn>\n``.  Inside role and text every backslash, ``#`` and
``<`` (and in roles ``:``) gets a backslash before it, so the control strings ``###`` and ``</turn>``
never occur inside and the writing can be undone exactly.

Two conversations share their first n turns when roles and texts of those turns are equal.  Each
node of the prefix tree belongs to the smallest conversation that passes through it; the turns a
conversation owns are then always its last ones, its *segment*.  Segments are emitted depth-first:
their order is that of the chain of owners from the root, and a range partitioning of these chains
spreads even a tree that holds a third of all conversations.  A segment's tokens continue the
position ids of its prefix and attend to the token intervals of its ancestors.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from docsignal.llm.common import key_back, key_column, list_array, map_batches, materialize

# The template.
OPEN, CLOSE, END = "### ", ": ", "</turn>\n"
LOSS_ROLE = "assistant"

TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\<])*)</turn>\n", re.S)


def escape(text: str, role: bool = False) -> str:
    return re.sub(r"([\\#<:])" if role else r"([\\#<])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """Header, body and end of one turn; only the body can bear loss."""
    return OPEN + escape(role, role=True) + CLOSE, escape(text), END


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation; fails if it isn't one."""
    turns, at = [], 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn starts at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


class ByteTokens:
    """Ids of the byte-level vocabulary in a ``.tiktoken`` file; control strings are ordinary text."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    @classmethod
    def of_process(cls, path: str) -> ByteTokens:
        """The one of this Python worker: read once, not once a task."""
        kept = sys.modules.setdefault("_docsignal_kept", types.ModuleType("_docsignal_kept")).__dict__
        if ("bytes", path) not in kept:
            kept["bytes", path] = cls(path)
        return kept["bytes", path]

    def ids(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def text(self, ids: list[int]) -> str:
        return self.encoding.decode_bytes(ids).decode("utf-8")


def conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: a conversation's turns in order, as one row.

    NULL role or text counts as empty, a NULL turn number stands first, rows with equal numbers are
    ordered by role and text and all kept.  A conversation is the unit of work and must fit in a
    task, as a document must.
    """
    empty = F.lit("")
    turn = F.struct(
        "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    rows = turns.select(key_column("conv_id").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def owners(convs: DataFrame) -> DataFrame:
    """``(conv_id, owner per turn)``: which conversation emits each turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, depth, path = [], [], []
            for key, turns in zip(batch.column(0).to_pylist(), roles_and_texts(batch.column(1))):
                digest = b""
                for i, turn in enumerate(turns):
                    digest += "".join(format_turn(*turn)).encode()
                    digest = hashlib.sha256(digest).digest()
                    conv.append(key)
                    depth.append(i)
                    path.append(digest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.int64()), pa.array(depth, pa.int32()), pa.array(path, pa.binary())],
                names=["conv_id", "depth", "path"],
            )

    nodes = map_batches(convs, run, "conv_id long, depth int, path binary")
    first = nodes.groupBy("path").agg(F.min("conv_id").alias("owner"))
    pairs = F.sort_array(F.collect_list(F.struct("depth", "owner")))
    return (
        nodes.join(first, "path")
        .groupBy("conv_id")
        .agg(F.transform(pairs, lambda p: p["owner"]).alias("owners"))
    )


def roles_and_texts(turns: pa.Array) -> Iterator[list[tuple[str, str]]]:
    """``(role, text)`` of every conversation's turns, from their Arrow column."""
    ends, flat = turns.offsets.to_pylist(), turns.values
    pairs = list(zip(flat.field("role").to_pylist(), flat.field("text").to_pylist()))
    return (pairs[a:b] for a, b in zip(ends[:-1], ends[1:]))


def rows_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of a list column as numpy views."""
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return (flat[a:b] for a, b in zip(ends[:-1], ends[1:]))


SEGMENT = (
    "conv_id long, chain array<long>, skip int, ids array<int>, loss array<boolean>,"
    " turn_ends array<int>"
)


def segments(convs: DataFrame, owned: DataFrame, tokenizer_path: str) -> DataFrame:
    """The owned turns of each conversation as tokens, with the chain of owners as sort key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens.of_process(tokenizer_path)
        for batch in batches:
            known: dict[str, list[int]] = {}  # each different part of a batch is tokenised once
            keys, chains, skips, ids, loss, ends, sizes = [], [], [], [], [], [], []
            columns = zip(batch.column(0).to_pylist(), roles_and_texts(batch.column(1)), batch.column(2).to_pylist())
            for key, turns, chain in columns:
                skip = next((i for i, owner in enumerate(chain) if owner == key), len(chain))
                if skip == len(chain):
                    continue
                before, own = len(ids), []
                for role, text in turns[skip:]:
                    for n, part in enumerate(format_turn(role, text)):
                        if part not in known:
                            known[part] = tokens.ids(part)
                        ids += known[part]
                        loss.append((n == 1 and role == LOSS_ROLE, len(known[part])))
                    own.append(len(ids) - before)
                keys.append(key)
                chains.append(list(dict.fromkeys(chain)))
                skips.append(skip)
                ends.append(own)
                sizes.append(len(ids) - before)
            bears, times = zip(*loss) if loss else ((), ())
            marked = np.repeat(np.array(bears, bool), np.array(times, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(chains, pa.list_(pa.int64())), pa.array(skips, pa.int32()),
                 list_array(np.array(ids, np.int32), np.array(sizes, np.int64)),
                 list_array(marked, np.array(sizes, np.int64)), pa.array(ends, pa.list_(pa.int32()))],
                names=SEGMENT_NAMES,
            )

    return map_batches(
        convs.join(owned, "conv_id").select("conv_id", "turns", "owners"), run, SEGMENT
    )


SEGMENT_NAMES = ["conv_id", "chain", "skip", "ids", "loss", "turn_ends"]


def place_depth_first(found: DataFrame) -> DataFrame:
    """Segments with ``start``, their first token's place in the depth-first stream of all trees.

    Segments are range-partitioned by chain (a prefix sorts before what continues it, which is
    depth-first order), numbered within partitions, and shifted by the token counts of the
    partitions before: one line per partition is summed up and broadcast.  ``found`` should be
    a written table, since its chains are read twice, the first time to find the ranges.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = np.diff(batch.column(3).offsets.to_numpy())
            ends = at + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(sizes), part, np.int32)),
                 pa.array(ends - sizes, pa.int64())],
                names=SEGMENT_NAMES + ["part", "local"],
            )
            at = int(ends[-1]) if len(ends) else at

    ordered = found.repartitionByRange("chain").sortWithinPartitions("chain")
    numbered = map_batches(ordered, run, SEGMENT + ", part int, local long")
    numbered = materialize(numbered, "chat-segments")
    size = F.size("ids").cast("long")
    totals = numbered.groupBy("part").agg(F.max(F.col("local") + size).alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(before, F.lit(0).cast("long")).alias("base"))
    placed = numbered.join(F.broadcast(bases), "part")  # one line a partition
    return placed.withColumn("start", F.col("local") + F.col("base")).drop("part", "local", "base")


def spans(convs_owned: DataFrame, placed: DataFrame) -> DataFrame:
    """``(conv_id, order, owner, start, length)``: the pieces of the stream that make a conversation.

    The last turn that a conversation takes from an owner decides how far it follows that segment.
    """
    rows = convs_owned.select("conv_id", F.posexplode("owners").alias("depth", "owner"))
    follows = rows.groupBy("conv_id", "owner").agg(F.max("depth").alias("last"))
    layout = placed.select(F.col("conv_id").alias("owner"), "skip", "start", "turn_ends")
    end = F.element_at("turn_ends", F.col("last") - F.col("skip") + 1).cast("long")
    return follows.join(layout, "owner").select(
        "conv_id", F.col("last").alias("order"), "owner", "start", end.alias("length")
    )


def format_conversations(turns: DataFrame, tokenizer_path: str) -> tuple[DataFrame, DataFrame]:
    """The formatted trees of ``(conv_id, turn, role, text)`` rows: ``(stream, index)``.

    ``stream``, one row per segment in depth-first order of ``start``: ``conv_id`` (its owner),
    ``chain``, ``start``, ``position`` (of its first token; the others follow by one), ``attends``
    (ancestor intervals ``[start, end)`` in the stream, root first; within the segment attention is
    causal), ``ids``, ``loss`` (per token).  ``index``, one row per conversation and piece:
    ``conv_id, order, owner, start, length``.

    NULL and repeated values: see ``conversations``; a NULL conv_id is one conversation, the
    smallest.  Equal conversations are emitted once and indexed each.  Other columns are ignored;
    an empty table gives empty results.
    """
    convs = materialize(conversations(turns), "chat-conversations")
    owned = materialize(owners(convs), "chat-owners")
    found = materialize(segments(convs, owned, tokenizer_path), "chat-tokens")
    placed = place_depth_first(found)
    index = materialize(spans(owned, placed), "chat-index")
    piece = F.struct("order", "start", (F.col("start") + F.col("length")).alias("end"))
    before = index.where("conv_id != owner").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(piece)).alias("p"),
        F.sum("length").alias("position"),
    )
    stream = placed.join(before, "conv_id", "left").select(
        "conv_id", "chain", "start",
        F.coalesce("position", F.lit(0).cast("long")).alias("position"),
        F.transform(
            F.coalesce("p", F.expr("array()")), lambda x: F.struct(x["start"], x["end"])
        ).alias("attends"),
        "ids", "loss",
    )
    return stream, index


def read_back(stream: DataFrame, index: DataFrame, tokenizer_path: str) -> DataFrame:
    """Conversations rebuilt from the stream: per conversation its turns, loss and size digests."""
    pieces = index.join(
        stream.select(F.col("conv_id").alias("owner"), "ids", "loss"), "owner"
    ).select(
        "conv_id",
        F.struct(
            "order",
            F.slice("ids", F.lit(1), F.col("length").cast("int")).alias("ids"),
            F.slice("loss", F.lit(1), F.col("length").cast("int")).alias("loss"),
        ).alias("p"),
    )
    whole = F.sort_array(F.collect_list("p"))
    rebuilt = pieces.groupBy("conv_id").agg(whole.alias("p")).select(
        "conv_id",
        F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"),
        F.flatten(F.transform("p", lambda x: x["loss"])).alias("loss"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens.of_process(tokenizer_path)
        for batch in batches:
            rows = []
            columns = zip(batch.column(0).to_pylist(), rows_of(batch.column(1)), rows_of(batch.column(2)))
            for key, ids, loss in columns:
                formatted = tokens.text(ids.tolist())
                turns = parse(formatted)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                learned = unescape(tokens.text(ids[loss].tolist()))
                rows.append(
                    (key, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest(), len(formatted))
                )
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=SUMMARY_NAMES,
            )

    out = map_batches(rebuilt, run, SUMMARY)
    return out.withColumn("conv_id", key_back("conv_id"))


SUMMARY = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)
SUMMARY_NAMES = [
    "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
]
