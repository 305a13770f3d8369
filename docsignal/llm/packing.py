"""Packing token sequences into windows by minimum bin slack.

Documents become token ids and one closing id.  Full windows are cut off at once.  The remainders
(shorter than a window) wait in a buffer of bounded size; from its lengths, kept as a multiset, each
window is filled by a subset-sum dynamic programme over bitsets: bit ``s`` of a step says that a
multiset of the lengths seen so far sums to ``s``.  The search stops as soon as the window can be
filled exactly, and the counts of each length are found by walking the steps back.  The window is
then as close to its capacity as the buffer allows.

Each Spark partition packs its own documents: no shuffle, and nothing but the buffer in memory.
What is left at the end of a partition and fills no window well is cut at powers of two, the sizes
that need no padding.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from docsignal.llm.common import map_batches

CAPACITY = 2048
END_ID = 1
BUFFER_PIECES = 2048
SCHEMA = (
    "doc_id long, start long, length long, ids array<int>, doc_tokens long, sequence_id long,"
    " offset long, ids_crc32 long"
)


def tokenizer(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids of texts as the tokenizer file gives them without added special tokens.

    ``.json`` files are read by ``tokenizers``.  If ranks of the same vocabulary lie beside it
    (``.tiktoken``), ordinary texts go through the faster library, which gives the same ids (a test
    holds them together); texts with a special token's string stay with ``tokenizers``.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    ranks = path.removesuffix(".json") + ".tiktoken"

    def slow(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in exact.encode_batch(texts, add_special_tokens=False)]

    if not os.path.exists(ranks):
        return slow
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    # Fixed value: the split pattern of that vocabulary, in its non-backtracking form.
    pattern = (
        r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
    )
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(texts: list[str]) -> list[list[int]]:
        return [
            slow([t])[0] if any(s in t for s in special) else fast.encode_ordinary(t) for t in texts
        ]

    return ids


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that their sum comes closest to ``capacity`` from below.

    The longest length is always taken, so that long pieces do not pile up; ties go to the longer
    lengths.  ``counts`` is not changed.
    """
    longest = max(counts)
    room, chosen = capacity - longest, {longest: 1}
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []  # (length, copies as one item, reachable sums before the step)
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, copies = min(counts[length] - (length == longest), room // length), 1
        while left > 0 and not reach >> room & 1:  # binary splitting of the copies
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            copies *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def windows(
    pieces: list[tuple[int, object]], capacity: int, keep: int = 0
) -> Iterator[list[tuple[int, object]]]:
    """Groups of ``(length, item)`` pieces, one per window, until at most ``keep`` pieces are left.

    The pieces left stay in ``pieces``.
    """
    by_length = defaultdict(list)
    for length, item in pieces:
        by_length[length].append(item)
    counts = {n: len(items) for n, items in by_length.items()}
    left = len(pieces)
    while left > keep:
        group = []
        for length, n in fill(counts, capacity).items():
            group += [(length, by_length[length].pop()) for _ in range(n)]
            counts[length] -= n
            if not counts[length]:
                del counts[length]
        left -= len(group)
        yield group
    pieces[:] = [(n, item) for n, items in by_length.items() for item in items]


def power_cuts(total: int, capacity: int) -> list[int]:
    """``total`` as sizes without padding: windows, then the powers of two of the rest."""
    sizes, rest = [capacity] * (total // capacity), total % capacity
    return sizes + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    buffer_pieces: int = BUFFER_PIECES,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents with their ids and their place in a sequence.

    Returns ``doc_id, start, length, ids, doc_tokens, sequence_id, offset, ids_crc32`` (unsigned, of
    the ids as little-endian unsigned 32-bit numbers).  Every id lies in one piece; the pieces of a sequence stand gapless from offset 0 to at most ``capacity``.

    NULL or empty text: the closing id alone.  NULL keys are kept.  Repeated rows and texts are
    packed as often as they come.  A text of any length is cut into windows; it must fit in a
    task's memory once.  Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 33
        waiting: list[tuple[int, tuple]] = []
        out: list[tuple] = []

        def place(group: list[tuple[int, tuple]]) -> None:
            nonlocal sequence
            offset = 0
            for length, (doc, start, ids, doc_tokens) in group:
                out.append((doc, start, length, ids, doc_tokens, sequence, offset))
                offset += length
            sequence += 1

        def flush() -> pa.RecordBatch:
            doc, start, length, ids, tokens, seq, offset = zip(*out) if out else [()] * 7
            ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            out.clear()
            columns = [pa.array(c, pa.int64()) for c in (doc, start, length)]
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())))
            crc = [crc_of_ids(x) for x in ids]
            columns += [pa.array(c, pa.int64()) for c in (tokens, seq, offset, crc)]
            return pa.RecordBatch.from_arrays(columns, names=NAMES)

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, doc in enumerate(keys):
                ids = np.array([*encode([texts[i].as_py() or ""])[0], end_id], np.int32)
                cut = len(ids) // capacity * capacity
                for start in range(0, cut, capacity):
                    place([(capacity, (doc, start, ids[start : start + capacity], len(ids)))])
                if cut < len(ids):
                    waiting.append((len(ids) - cut, (doc, cut, ids[cut:], len(ids))))
                if len(waiting) >= buffer_pieces:
                    for group in windows(waiting, capacity, keep=buffer_pieces // 2):
                        place(group)
                if len(out) >= 1000:
                    yield flush()
        groups = list(windows(waiting, capacity))
        while groups and sum(n for n, _ in groups[-1]) == capacity:
            place(groups.pop())
        for group in groups:
            if sum(n for n, _ in group) >= capacity - capacity // 256:
                place(group)
            else:
                waiting += group
        for group in _cut(waiting, power_cuts(sum(n for n, _ in waiting), capacity)):
            place(group)
        if out:
            yield flush()

    return map_batches(docs.select(key, text), run, SCHEMA)


NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "ids_crc32"]


def _cut(pieces: list[tuple[int, tuple]], sizes: list[int]) -> Iterator[list[tuple[int, tuple]]]:
    """Cut pieces, in order, into groups of exactly the given sizes."""
    queue = list(reversed(pieces))
    for size in sizes:
        group = []
        while size:
            length, (doc, start, ids, tokens) = queue.pop()
            take = min(length, size)
            group.append((take, (doc, start, ids[:take], tokens)))
            if take < length:
                queue.append((length - take, (doc, start + take, ids[take:], tokens)))
            size -= take
        yield group


def crc_of_ids(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
