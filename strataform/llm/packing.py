"""Packing by concatenate and cut.

Documents are tokenised once into a written table that also holds, for every
document, the number of ids before it inside its own partition.  The second
pass needs only one total per partition: their prefix sum is each partition's
global offset.  Every document then knows where it lies in the one long
concatenation and is cut at multiples of the window length, without a sort or
a shuffle of ids.  A document over a window boundary gives one record on each
side of it.

Defined results: null text counts as empty; an empty text is one piece holding
the end id alone; an empty table gives no piece; repeated rows, and rows with a
null id, are packed once each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import subwords
from .common import scratch_table, text_blocks, texts_of

_ROWS = 256  # documents tokenised at a time

IDS_SCHEMA = "doc_id bigint, part int, before bigint, n_ids bigint, ids binary"
PIECE_SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, "
                "doc_tokens bigint, sequence_id bigint, offset bigint")


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


def tokenised(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Ids of each document with the end id, as little-endian unsigned 32-bit
    numbers, and the number of ids before it in its partition; a written table."""
    schema = _arrow(IDS_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords.word_bpe(vocabulary)
        end = np.asarray([end_id], "<u4").tobytes()
        before = 0
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                ids = []
                for first, last, *_ in text_blocks(some.column(2)):
                    texts = texts_of(some.column(2).slice(first, last - first))
                    ids += [np.frombuffer(x, encoder.dtype).astype("<u4").tobytes() + end
                            for x in encoder.encode_batch(texts)]
                n = np.asarray([len(x) // 4 for x in ids], np.int64)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(starts), pa.array(n),
                     pa.array(ids, pa.binary())], schema=schema)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.spark_partition_id().alias("part"),
                       F.col(text_col).cast("string").alias("text"))
    return scratch_table(rows.mapInArrow(run, IDS_SCHEMA), "packing-ids")


def partition_offsets(ids: DataFrame) -> DataFrame:
    """Global offset of each partition: one row for each, so the single-task
    prefix sum grows with the number of partitions, not of documents."""
    totals = ids.groupBy("part").agg(F.sum("n_ids").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0))
                         .cast("bigint").alias("part_start"))


def cut_windows(ids: DataFrame, window: int) -> DataFrame:
    """Pieces of every document in fixed windows of ``window`` ids."""
    schema = _arrow(PIECE_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                doc, first, ids_col = some.column(0), some.column(1).to_numpy(), some.column(2)
                n = np.asarray([len(x.as_buffer()) // 4 for x in ids_col], np.int64)
                # One piece for each window that [first, first + n) touches.
                pieces = (first + n - 1) // window - first // window + 1
                row = np.repeat(np.arange(len(n)), pieces)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                sequence = first[row] // window + nth
                start = np.maximum(sequence * window, first[row]) - first[row]
                stop = np.minimum((sequence + 1) * window, first[row] + n[row]) - first[row]
                held = [memoryview(x.as_buffer()) for x in ids_col]
                crc = [zlib.crc32(held[r][4 * a:4 * b]) for r, a, b in
                       zip(row.tolist(), start.tolist(), stop.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [doc.take(pa.array(row)), pa.array(start), pa.array(stop - start),
                     pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(sequence),
                     pa.array(first[row] + start - sequence * window)], schema=schema)

    placed = ids.join(F.broadcast(partition_offsets(ids)), "part").select(
        "doc_id", (F.col("part_start") + F.col("before")).alias("first"), "ids")
    return placed.mapInArrow(run, PIECE_SCHEMA)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, window: int = 4096,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents packed into sequences of ``window`` ids; only the last
    sequence can hold fewer.

    One row per piece: ``doc_id``, ``start`` (ids of the document before it),
    ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.
    """
    return cut_windows(tokenised(docs, vocabulary, end_id, id_col, text_col), window)
