"""Exact deduplication by a stateful stream.

Rows arrive as a stream.  State is kept on disk (RocksDB), keyed by the digest of the normalised
text, and never expires: for each digest it retains how many rows came, the stable identifier that
stays (the largest key) and the locator of that row's content.  A hot digest is combined within each
task before it reaches its state, so a third of all rows sharing one text costs a few state updates.

A digest alone decides nothing: the full bytes of all rows whose digest came more than once (hits)
are compared.  Should one digest cover different texts, its rows are grouped by their bytes instead.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from docsignal.llm.common import (
    NULL_KEY, key_back, key_bitmap, key_column, map_batches, materialize, maybe_in,
)
from docsignal.session import checkpoint_root

STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Many small stores: no preallocated files, and only changes are uploaded.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def normalise(column: pa.Array) -> pa.Array:
    """Lower-case A-Z only; NULL counts as empty."""
    return pc.ascii_lower(column.cast(pa.large_string()).fill_null(""))


def _thin(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(key_column(key).alias("doc_id"), F.col(f"`{text}`").alias("text"))


def _digest(value: pa.Scalar, hex_digits: int) -> tuple[str, str, int]:
    data = value.as_buffer()
    full = hashlib.sha256(data).hexdigest()
    return full, full[:hex_digits], data.size


def digests(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    hex_digits: int = 64,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(doc_id, n_bytes, text_sha256, digest)`` of every row, and the columns in ``carry``.

    ``digest`` is the state key: the leading ``hex_digits`` of the SHA-256 of the normalised text
    (fewer than 64 only to provoke collisions in tests).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_digest(v, hex_digits) for v in normalise(batch.column(1))]
            full, short, size = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(full, pa.string()),
                 pa.array(short, pa.string()), *batch.columns[2:]],
                names=["doc_id", "n_bytes", "text_sha256", "digest", *carry],
            )

    schema = "doc_id long, n_bytes long, text_sha256 string, digest string"
    schema += "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    own = [key_column(key).alias("doc_id"), F.col(f"`{text}`").alias("text")]
    return map_batches(
        docs.select(*own, *[F.col(c).alias(f"carry_{c}") for c in carry]), run, schema
    )


def group_state(stream: DataFrame) -> DataFrame:
    """The keyed state of a stream of ``(digest, doc_id, row)``: one row per digest, no expiry.

    ``keep`` holds the identifier that stays and the locator of its row; ``group_size`` counts rows.
    """
    return stream.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")
    )


def run_stream(feed: DataFrame, files_per_batch: int, state_partitions: int | None) -> DataFrame:
    """Stream the files of ``feed`` to their end; the last state of every digest."""
    spark: SparkSession = feed.sparkSession
    place = f"{checkpoint_root(spark).rstrip('/')}/dedup-{uuid.uuid4().hex}"
    path = feed.inputFiles()[0].rpartition("/")[0]
    settings = dict(STATE)
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        source = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", files_per_batch)
        query = (
            group_state(source.parquet(path))
            .writeStream.outputMode("update")
            .foreachBatch(
                lambda batch, n: batch.withColumn("batch", F.lit(n).cast("long"))
                .write.mode("overwrite")
                .parquet(f"{place}/updates/{n}")
            )
            .option("checkpointLocation", f"{place}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = (
        "digest string, keep struct<doc_id: long, row: long>, group_size long, batch long"
    )
    updates = spark.read.schema(schema).option("recursiveFileLookup", "true")
    last = F.max(F.struct("batch", "keep", "group_size")).alias("s")
    return (
        updates.parquet(f"{place}/updates")
        .groupBy("digest")
        .agg(last)
        .select("digest", "s.keep", "s.group_size")
    )


def deduplicate(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    files_per_batch: int = 512,
    state_partitions: int | None = None,
    hex_digits: int = 64,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z.  Of equal texts the row with the largest
    key stays; of rows repeated with that key, one.

    NULL text counts as empty.  A NULL key is smaller than any other.  Other columns are ignored.
    An empty table gives no rows.  ``files_per_batch`` sets how much one micro-batch takes.
    """
    feed = digests(docs, key, text, hex_digits).withColumn("row", F.monotonically_increasing_id())
    feed = materialize(feed, "dedup-feed")
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    if feed.isEmpty():
        return feed.select(
            "doc_id", F.col("doc_id").alias("keep_id"), F.col("row").alias("group_size"),
            F.lit(True).alias("kept"), "text_sha256",
        )
    groups = materialize(run_stream(feed, files_per_batch, state_partitions), "dedup-groups")
    hits = hit_texts(docs, groups.where("group_size > 1"), key, text, hex_digits)
    unequal = materialize(
        hits.groupBy("digest")
        .agg(F.min("content").alias("a"), F.max("content").alias("b"))
        .where("a != b")
        .select("digest"),
        "dedup-unequal",
    )
    rows = feed.join(groups, "digest")
    if not unequal.isEmpty():
        rows = rows.join(unequal, "digest", "left_anti")
    rows = rows.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256",
    )
    if not unequal.isEmpty():
        same = Window.partitionBy("digest", "content")
        apart = (
            hits.join(unequal, "digest")
            .withColumn("keep_id", F.max("doc_id").over(same))
            .withColumn("group_size", F.count("*").over(same))
            .withColumn("n", F.row_number().over(same.orderBy(F.desc("doc_id"))))
            .withColumn("kept", F.col("n") == 1)
        )
        rows = rows.unionByName(apart.select(*out))
    return rows.withColumns({c: key_back(c) for c in ("doc_id", "keep_id")}).select(*out)


def unique_rows(docs: DataFrame, columns: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``columns`` of the rows of ``docs`` that stay: one of each group of equal texts."""
    stays = deduplicate(docs, key, text).where("kept").select(
        F.coalesce("doc_id", F.lit(NULL_KEY)).alias("doc_id"), "text_sha256"
    )
    others = [c for c in columns if c != key]
    rows = digests(docs, key, text, carry=others).drop("n_bytes", "digest")
    both = ["doc_id", "text_sha256"]
    rows = rows.join(stays, both).dropDuplicates(both)
    return rows.withColumn("doc_id", key_back("doc_id")).withColumnRenamed("doc_id", key).select(*columns)


def hit_texts(docs: DataFrame, found: DataFrame, key: str, text: str, hex_digits: int) -> DataFrame:
    """``(doc_id, text_sha256, digest, content)`` of the rows whose digest may be in ``found``.

    A second pass over the texts; a bitmap of fixed size leaves out most rows of other digests.
    What is grouped afterwards is combined within tasks first, so a hot digest ships few texts.
    """
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(
        key_bitmap(found.select(F.crc32("digest").alias("h")), "h", bits=24)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = normalise(batch.column(1))
            full, short = [], []
            for value in texts:
                a, b, _ = _digest(value, hex_digits)
                full.append(a)
                short.append(b)
            tags = np.array([zlib.crc32(s.encode()) for s in short], np.uint64)
            take = pa.array(maybe_in(bitmap.value, tags) if len(tags) else np.zeros(0, bool))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(take), pa.array(full, pa.string()).filter(take),
                 pa.array(short, pa.string()).filter(take),
                 texts.cast(pa.large_string()).filter(take).cast(pa.string())],
                names=["doc_id", "text_sha256", "digest", "content"],
            )

    schema = "doc_id long, text_sha256 string, digest string, content string"
    return map_batches(_thin(docs, key, text), run, schema)
