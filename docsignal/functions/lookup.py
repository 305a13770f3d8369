"""Constant-time lookups of a bounded word table inside a row expression.

The table becomes one constant: an array of small maps, addressed by ``crc32(word) % buckets``.
A plain map literal would be searched from the start for every word; a join would need a shuffle
to bring each document's words back together and could not run on a stream.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

MAX_ENTRIES = 100_000


def constant(values: Sequence, of: str = "double") -> Column:
    """A constant array in one expression node (folded once), however long it is."""
    plain = [v.item() if hasattr(v, "item") else v for v in values]
    return F.from_json(F.lit(json.dumps(plain)), f"array<{of}>")


def word_lookup(table: Mapping[str, float]) -> Callable[[Column], Column]:
    """Return ``word column -> value or NULL`` for a table of at most ``MAX_ENTRIES`` words."""
    buckets = _buckets(table)
    constant = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,double>>")

    def find(word: Column) -> Column:
        bucket = F.get(constant, (F.crc32(word) % len(buckets)).cast("int"))
        return F.try_element_at(bucket, word)

    return find


def _buckets(table: Mapping[str, float]) -> list[dict[str, float]]:
    if len(table) > MAX_ENTRIES:
        raise ValueError(f"word table has {len(table)} entries, limit is {MAX_ENTRIES}")
    buckets: list[dict[str, float]] = [{} for _ in range(max(1, len(table)))]
    for word, value in table.items():
        buckets[zlib.crc32(word.encode()) % len(buckets)][word] = float(value)
    return buckets


def word_lookup_sql(table: Mapping[str, float]) -> Callable[[str], str]:
    """The same lookup as SQL text: ``word expression -> value or NULL``."""
    buckets = _buckets(table)
    literal = json.dumps(buckets).replace("\\", "\\\\").replace("'", "\\'")
    constant = f"from_json('{literal}', 'array<map<string,double>>')"
    return lambda w: f"try_element_at(get({constant}, cast(crc32({w}) % {len(buckets)} AS INT)), {w})"
