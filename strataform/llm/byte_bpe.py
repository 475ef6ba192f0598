"""Byte-level BPE by overlapping chunks.

Texts are cut into chunks that overlap.  Each chunk is split by the pre-token
pattern on its own, in parallel, starting at a place that need not be a
boundary of the whole text.  From the first place where the boundaries of two
neighbouring chunks agree inside their overlap the later chunk's split is the
true one: the pattern looks only forward.  The text is cut there, and the
pieces are encoded by themselves; where an overlap holds no common boundary,
the two chunks are one piece.  Ids of a text are its pieces' ids in order;
decoding concatenates the raw bytes of the ids.

A text no longer than a chunk is one chunk and needs no stitching, so it is
encoded where it is read.

Defined results: null text counts as empty and has no ids; repeated rows and
null ids give one row each; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import subwords
from .common import partitions_for, texts_of, with_field

_ROWS = 256
#: Matches that end closer than this to a chunk's end may be cut short: the
#: pattern's fixed strings have at most three characters, and it looks one ahead.
_MARGIN = 4


def split_chunks(texts: DataFrame, chunk_chars: int, overlap_chars: int) -> DataFrame:
    """Rows (row, doc_id, chunk, base, text): chunk k starts ``overlap_chars``
    before character k * chunk_chars (base) and reaches the overlap beyond
    the next one's nominal start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3)),
                                      strict=True):
                for k in range(-(-len(text) // chunk_chars)):
                    base = max(0, k * chunk_chars - overlap_chars)
                    part = text[base:(k + 1) * chunk_chars + _MARGIN]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([doc], pa.int64()),
                         pa.array([k], pa.int32()), pa.array([base], pa.int64()),
                         pa.array([(k + 1) * chunk_chars >= len(text)]), pa.array([part])],
                        ["row", "doc_id", "chunk", "base", "last", "text"])

    return texts.select("row", "doc_id", "text").mapInArrow(
        run, "row bigint, doc_id bigint, chunk int, base bigint, last boolean, text string")


def chunk_boundaries(chunks: DataFrame, pattern: str, chunk_chars: int,
                     overlap_chars: int) -> DataFrame:
    """Adds ``head`` and ``tail``: the chunk's pre-token boundaries inside its
    overlap with the chunk before and after it, as positions of the text.

    Only boundaries behind a non-space count, so that no piece ends in white
    space that the pattern would group differently at the end of a text.
    """
    places = T.ArrayType(T.LongType())
    schema = with_field(chunks.schema, ("head", places), ("tail", places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pat = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for k, base, last, text in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)),
                                           strict=True):
                ends = [base + m.end() for m in pat.finditer(text)
                        if (last or m.end() <= len(text) - _MARGIN) and not m[0][-1].isspace()]
                low, high = k * chunk_chars, (k + 1) * chunk_chars
                heads.append([p for p in ends if p <= low] if k else [])
                tails.append([] if last else [p for p in ends
                                              if high - overlap_chars < p <= high])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.list_(pa.int64())),
                 pa.array(tails, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "head", "tail"])

    return chunks.mapInArrow(run, schema)


def stitch(bounded: DataFrame, chunk_chars: int) -> DataFrame:
    """Pieces (row, doc_id, piece, text) cut where neighbours resynchronise."""
    by_row = Window.partitionBy("row").orderBy("chunk")
    cut = F.array_min(F.array_intersect(F.lag("tail").over(by_row), "head"))
    cuts = bounded.withColumn("cut", cut)
    nominal = F.col("chunk") * F.lit(chunk_chars)
    start = F.coalesce("cut", nominal.cast("bigint"))
    stop = F.lead(start).over(by_row)
    pieces = cuts.select(
        "row", "doc_id", "chunk", "base", "text", start.alias("start"), stop.alias("stop"),
        F.sum(F.when(F.col("cut").isNotNull() | (F.col("chunk") == 0), 1).otherwise(0))
        .over(by_row).alias("piece"))
    length = F.coalesce(F.col("stop") - F.col("start"), F.lit(chunk_chars * 2)).cast("int")
    part = F.col("text").substr((F.col("start") - F.col("base") + 1).cast("int"), length)
    # Chunks without a common boundary between them make one piece.
    return (pieces.groupBy("row", "doc_id", "piece")
            .agg(F.array_sort(F.collect_list(F.struct("chunk", part.alias("part"))))
                 .alias("parts"))
            .select("row", "doc_id", "piece",
                    F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("text")))


def encode_column(rows: DataFrame, text: str, rank_file: str, pattern: str) -> DataFrame:
    """``rows`` with ``text`` replaced by ``ids`` (array<int>)."""
    keep = [c for c in rows.columns if c != text]
    schema = with_field(rows.select(*keep).schema, ("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords.byte_bpe(rank_file, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                ids = [np.frombuffer(x, encoder.dtype)
                       for x in encoder.encode_batch(texts_of(some.column(len(keep))))]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate([*ids, ends[:0]]).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], lists],
                                                 names=[*keep, "ids"])

    return rows.select(*keep, text).mapInArrow(run, schema)


def encode(docs: DataFrame, rank_file: str, pattern: str, chunk_chars: int = 1 << 16,
           overlap_chars: int = 1 << 9, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and ids (array<int>)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    short = encode_column(rows.where(F.length("text") <= chunk_chars), "text", rank_file, pattern)
    long_rows = rows.where(F.length("text") > chunk_chars).withColumn(
        "row", F.monotonically_increasing_id())
    chunks = split_chunks(long_rows, chunk_chars, overlap_chars).repartition(
        partitions_for(docs), "row", "chunk")
    pieces = stitch(chunk_boundaries(chunks, pattern, chunk_chars, overlap_chars), chunk_chars)
    encoded = encode_column(pieces, "text", rank_file, pattern)
    whole = encoded.groupBy("row", "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("pieces")).select(
        "doc_id", F.flatten(F.transform("pieces", lambda p: p["ids"])).alias("ids"))
    return short.unionByName(whole)


def decode_column(rows: DataFrame, ids: str, rank_file: str, pattern: str) -> DataFrame:
    """``rows`` with a column ``decoded`` (binary): the ids' bytes in order."""
    names = rows.columns
    schema = with_field(rows.schema, ("decoded", T.BinaryType()))
    at_ids = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = subwords.byte_bpe(rank_file, pattern).table.__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                lists = some.column(at_ids)
                values = lists.values.to_numpy(zero_copy_only=False)
                ends = lists.offsets.to_numpy()
                raw = [b"".join(map(table, values[a:b].tolist()))
                       for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(raw, pa.binary())],
                                                 names=[*names, "decoded"])

    return rows.mapInArrow(run, schema)


def ids_digest(ids: str) -> Column:
    """SHA-256 of the decimal ids joined by commas, lowercase hex."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256)
