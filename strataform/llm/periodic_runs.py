"""Runs: stretches of words that repeat with a period, found in every text.

A run is a stretch of consecutive words with smallest period q that is at least
``max(MIN_WORDS, 2 * q)`` words long and that no neighbouring word extends.  Each
text is cut into blocks at dyadic scales; block convolution (``block_match``)
finds where each block recurs in the window that follows it.  A run of period q
holds a whole aligned block of the scale of q together with its copy q words
later, so the distances found seed all runs:

* neighbouring blocks that recur at one distance form one seed, which can be
  extended by less than a block at either end;
* a seed inside a run found before, whose period is no longer than the block, is
  a repetition of that period (Fine and Wilf) and is left out;
* of stretches with the same ends the smallest period is kept, which leaves out
  multiples of a period.

Work and memory are about n * log(n)^2 and n for a text of n words.

Defined results: null text, and text without words, has no run and an empty
collapsed text; a text of any length is one unit of work, its blocks are
transformed in chunks of a fixed size; equal lengths are told apart by start,
then period; repeated rows and null ids give one row each; ids may be of any
type; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .block_match import recurrences
from .common import ASCII_SPACE, texts_of

MIN_WORDS = 12
#: Words taken up together by a task; one text is never cut.
GROUP_WORDS = 1 << 17


def word_numbers(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; a number for every word, the same for equal words of
    one text; the bounds of the texts; how many numbers each text has."""
    words, numbers, tops = [], [], []
    for text in texts:
        found = text.split()  # bytes: only ASCII white space separates
        known: dict[bytes, int] = {}
        numbers.append(np.fromiter((known.setdefault(w, len(known)) for w in found),
                                   np.int64, len(found)))
        words.append(found)
        tops.append(len(known))
    bounds = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=bounds[1:])
    return (words, np.concatenate(numbers) if numbers else np.empty(0, np.int64), bounds,
            np.array(tops, np.int64))


def _scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(block width, lowest and highest distance + 1): a run of such a period
    holds an aligned block and its copy."""
    width, low, high = 2, 1, 8
    while 2 * low <= longest:
        yield width, low, high
        width, low, high = 2 * width, 4 * width, 8 * width


def _matched(numbers: np.ndarray, near: np.ndarray, far: np.ndarray, count: np.ndarray, step: int,
             width: int) -> np.ndarray:
    """How many of at most ``count`` words from ``near`` agree with those from
    ``far``, going on by ``step``."""
    out = np.zeros(len(near), np.int64)
    rows = max(1, (1 << 18) // max(1, width))
    for i in range(0, len(near), rows):
        at = np.arange(width)[None, :]
        inside = at < count[i:i + rows, None]
        move = np.where(inside, at, 0) * step
        last = len(numbers) - 1
        same = inside & (numbers[np.clip(near[i:i + rows, None] + move, 0, last)]
                         == numbers[np.clip(far[i:i + rows, None] + move, 0, last)])
        out[i:i + rows] = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    return out


def find_runs(numbers: np.ndarray, bounds: np.ndarray, tops: np.ndarray,
              min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, end, period) of all runs in the texts that lie one after the
    other in ``numbers``, sorted by start, then period."""
    if min_words < 12:
        raise ValueError("the smallest scale finds runs of 12 words or more")
    sizes = np.diff(bounds)
    runs = np.empty((0, 3), np.int64)
    for width, low, high in _scales(int(sizes.max(initial=0))):
        texts = np.flatnonzero(sizes >= max(min_words, 2 * low))
        blocks = (sizes[texts] - low) // width
        owner = np.repeat(texts, blocks)
        first = np.cumsum(blocks) - blocks
        starts = bounds[owner] + width * (np.arange(len(owner)) - np.repeat(first, blocks))
        room = bounds[owner + 1] - starts - width
        b, q = recurrences(numbers, starts, room, tops[owner], width, low, high)
        if not len(b):
            continue
        # Seeds inside a run whose period is no longer than the block.
        short = runs[runs[:, 2] <= width]
        short = short[np.argsort(short[:, 0], kind="stable")]
        reach = np.concatenate([[-1], np.maximum.accumulate(short[:, 1])])
        inside = b + q + width <= reach[np.searchsorted(short[:, 0], b, "right")]
        order = np.lexsort((b, q))
        b, q, inside = b[order], q[order], inside[order]
        new = np.ones(len(b), bool)
        new[1:] = (q[1:] != q[:-1]) | (b[1:] != b[:-1] + width)
        at = np.flatnonzero(new)
        begin, period = b[at], q[at]
        end = b[np.append(at[1:], len(b)) - 1] + width
        wanted = np.maximum(min_words - period, period)
        keep = (~np.logical_or.reduceat(inside, at)
                & (end - begin + 2 * (width - 1) >= wanted))
        begin, end, period, wanted = begin[keep], end[keep], period[keep], wanted[keep]
        text = np.searchsorted(bounds, begin, "right") - 1
        left = np.minimum(begin - bounds[text], width - 1)
        begin = begin - _matched(numbers, begin - 1, begin - 1 + period, left, -1, width - 1)
        right = np.minimum(bounds[text + 1] - end - period, width - 1)
        end = end + _matched(numbers, end, end + period, right, 1, width - 1)
        long = end - begin >= wanted
        found = np.stack([begin, end + period, period], axis=1)[long]
        # Of the same ends, the smallest period.
        runs = np.concatenate([runs, found])
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        first = np.ones(len(runs), bool)
        first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
        runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about ``GROUP_WORDS`` words (by their length)."""
    first, chars = 0, 0
    for i, text in enumerate(texts):
        if i > first and chars + len(text) > 6 * GROUP_WORDS:
            yield first, i
            first, chars = i, 0
        chars += len(text)
    if first < len(texts):
        yield first, len(texts)


_RUN = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False)
                                 for n in ("start", "length", "period")]), False)


def runs_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: ``id_col``, n_words, runs (array of start, length,
    period, by start, then period; starts count words from 0) and collapsed (the
    words that no run holds after its first period, joined by one space)."""
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("runs", _RUN), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for first, last in _groups(texts):
                words, numbers, bounds, tops = word_numbers(
                    [t.encode() for t in texts[first:last]])
                runs = find_runs(numbers, bounds, tops, min_words)
                change = np.zeros(len(numbers) + 1, np.int64)
                np.add.at(change, runs[:, 0] + runs[:, 2], 1)
                np.add.at(change, runs[:, 1], -1)
                kept = np.cumsum(change[:-1]) == 0
                text = np.searchsorted(bounds, runs[:, 0], "right") - 1
                ends = np.searchsorted(text, np.arange(last - first + 1))
                collapsed = []
                for i, found in enumerate(words):
                    if ends[i] < ends[i + 1]:
                        stay = kept[bounds[i]:bounds[i + 1]]
                        found = [w for w, k in zip(found, stay.tolist(), strict=True) if k]
                    collapsed.append(b" ".join(found).decode())
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(runs[:, 0] - bounds[text]), pa.array(runs[:, 1] - runs[:, 0]),
                     pa.array(runs[:, 2])], names=["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.diff(bounds)), listed,
                     pa.array(collapsed, pa.string())], names=schema.names)

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("text")
                       ).mapInArrow(run, schema)


def run_report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digest columns of ``runs_of``: counts, the longest run, and hashes."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    named = found.withColumn("_best", best)
    return named.select(
        F.col(f"`{id_col}`"), "n_words", F.size("runs").cast("bigint").alias("n_runs"),
        F.col("_best.start").alias("start"), (-F.col("_best.minus")).alias("length"),
        F.col("_best.period").alias("period"),
        F.floor(F.lit(1000) * -F.col("_best.minus") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): the texts, of which those whose crc32 of the id is a multiple
    of 10 go on from some word by repeating the words before it."""
    h = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    # Fields of one struct, so that no name can clash.
    base = docs.select(F.struct(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, F.filter(F.split(F.col(f"`{text_col}`").cast("string"), ASCII_SPACE),
                                     lambda w: w != "")).alias("words")).alias("d"))
    d = base.withColumn("n", F.size("d.words")).withColumn("a", F.when(F.col("n") > 0, F.col("d.g") % F.col("n")))
    d = d.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("d.g") % 8)))
    repeated = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get(
        F.col("d.words"), F.when(i < F.col("a"), i).otherwise(
            F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return d.select(F.col("d.id").alias(id_col), F.when(
        F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("d.text")).alias(text_col))


def longest_first(found: DataFrame) -> Column:
    """The runs of ``runs_of`` by falling length, then start, then period."""
    return F.transform(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period")))),
        lambda r: F.struct(r["start"].alias("start"), (-r["minus"]).alias("length"),
                           r["period"].alias("period")))
