"""License scans by an exact set-similarity join, in DataFrame functions only.

Texts are split into blocks at sentence ends and blank lines; a single line feed
ends none, so a notice wrapped over lines is one block.  A block matches a
template when it holds at least ``threshold`` of the template's distinct words.
The join finds every such pair without comparing all of them:

* words are put in one global order, rarest in the blocks first; a block that
  holds c of a template's t words holds one of its t - c + 1 rarest, so only
  blocks with a word of that prefix are candidates (prefix filter);
* a block with fewer than c template words cannot match (length filter);
* from the first common word in that order, what is left of template and block
  bounds the overlap (positional filter);
* candidates are counted in full.

Besides, every place where the words of a known phrase stand consecutively is
counted, and gives that phrase's label.

The templates are a fixed list, so everything kept per template is bounded.  The
order counts template words over every block of every text that holds enough of
them to match the shortest template; any order gives the same matches.

Defined results: null text counts as empty: no words, no labels, score 0; a very
long text is scanned whole, and of a block, however long, only its distinct
template words are kept; words equally rare are ordered by themselves, and of
blocks that match a template equally well one counts; repeated rows and null ids
give one row each; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch_table

# Phrases and the labels they stand for.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices of well-known licenses and the labels they stand for.
TEMPLATES = {
    "all-rights-reserved": "all rights reserved",
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are "
           "permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of "
                 "this software and associated documentation files",
    "mit-notice": "released under the mit license",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}

THRESHOLD = 0.8

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A sentence end before white space, or blank lines.
_SPACE = r"[\x20\x09-\x0D]"
BLOCK_END = rf"[.!?;]{_SPACE}|\n[\x20\x09\x0B-\x0D]*\n"


def _phrase(words: str) -> str:
    return _GAP.join(words.split())


def _place(phrases) -> str:
    return f"(?<!{_WORD})(?:{'|'.join(map(_phrase, phrases))})(?!{_WORD})"


def lowered(text_col: str) -> Column:
    """Text with A-Z lowered, null as empty.  Letters outside A-Z change case
    too: they are word characters before and after, and only the Kelvin sign
    would become a letter of a-z, so it is replaced by another word character."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u00e5")))


def base_columns(lower: str, phrases: dict[str, str]) -> dict[str, Column]:
    """n_words, and places of the phrases: n_base, first_word, last_word, base_labels."""
    text = F.col(lower)
    word = F.lit(f"{_WORD}+")
    every = _place(phrases)
    # Only texts that hold some phrase's last two words can hold a place.
    near = reduce(lambda a, b: a | b, [text.contains(p.split()[-2]) & text.contains(p.split()[-1])
                                       for p in phrases])
    places = F.when(near, F.regexp_count(text, F.lit(every))).otherwise(0)
    some = near & (F.regexp_count(text, F.lit(every)) > 0)
    before_first = F.regexp_extract(text, f"(?s)^(.*?){every}", 1)
    before_last = F.regexp_extract(text, f"(?s)^(.*){every}", 1)
    labels = F.array(*[F.when(near & text.rlike(_place([p])), F.lit(label))
                       for p, label in phrases.items()])
    return {
        "n_words": F.regexp_count(text, word).cast("bigint"),
        "n_base": places.cast("bigint"),
        "first_word": F.when(some, F.regexp_count(before_first, word).cast("bigint")),
        "last_word": F.when(some, F.regexp_count(before_last, word).cast("bigint")),
        "base": F.array_sort(F.array_distinct(F.array_compact(labels))),
    }


def blocks_of(lower: str, vocabulary: list[str], least: int) -> Column:
    """For each block of the text its distinct words that are in the
    vocabulary, if there are at least ``least`` of them."""
    known = F.array(*map(F.lit, vocabulary))
    words = F.transform(F.split(F.col(lower), BLOCK_END),
                        lambda b: F.array_intersect(F.split(b, _GAP), known))
    return F.filter(words, lambda w: F.size(w) >= least)


def template_matches(blocks: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """Every (row, template label, containment) of a block that reaches the
    threshold; ``blocks`` has row and words (distinct, of the vocabulary)."""
    spark = blocks.sparkSession
    words = {label: sorted(set(text.split())) for label, text in templates.items()}
    counts = dict(blocks.select(F.explode("words").alias("w")).groupBy("w").count().collect())
    order = sorted({w for ws in words.values() for w in ws}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefixes = []
    for label, ws in words.items():
        need = math.ceil(threshold * len(ws) - 1e-9)
        ranks = sorted(rank[w] for w in ws)
        prefixes += [(order[r], i, label, ranks, need)
                     for i, r in enumerate(ranks[:len(ranks) - need + 1])]
    # A few rows for each template of the fixed list.
    prefix = F.broadcast(spark.createDataFrame(
        prefixes, "word string, t_at int, label string, t_ranks array<int>, need int"))
    ranked = F.create_map(*[x for w, r in rank.items() for x in (F.lit(w), F.lit(r))])
    sorted_blocks = blocks.select("row", F.array_sort(F.transform(
        "words", lambda w: ranked[w])).alias("ranks"))
    by_rank = F.array(*map(F.lit, order))
    tokens = sorted_blocks.select("row", "ranks", F.posexplode("ranks").alias("b_at", "r")).select(
        "row", "ranks", "b_at", by_rank[F.col("r")].alias("word"))
    left = F.least(F.size("t_ranks") - F.col("t_at"), F.size("ranks") - F.col("b_at"))
    common = F.array_intersect("ranks", "t_ranks")
    return (tokens.join(prefix, "word")
            .where((F.size("ranks") >= F.col("need")) & (left >= F.col("need")))
            # The pair is met once, at its first common word.
            .where(F.element_at(common, 1) == F.col("ranks")[F.col("b_at")])
            .where(F.size(common) >= F.col("need"))
            .select("row", "label", (F.size(common) / F.size("t_ranks")).alias("containment")))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES,
         phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (1 with a phrase, else the largest containment of
    a matching block, else 0)."""
    sets = [set(t.split()) for t in templates.values()]
    vocabulary = sorted(set().union(*sets))
    least = min(math.ceil(threshold * len(s) - 1e-9) for s in sets)
    lower = docs.select(F.col(id_col).alias("doc_id"), lowered(text_col).alias("lower"))
    rows = scratch_table(lower.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        *[c.alias(n) for n, c in base_columns("lower", phrases).items()],
        blocks_of("lower", vocabulary, least).alias("blocks")), "license-blocks")
    matches = template_matches(rows.select("row", F.explode("blocks").alias("words")),
                               templates, threshold)
    best = matches.groupBy("row").agg(F.collect_set("label").alias("more"),
                                      F.max("containment").alias("containment"))
    named = F.array_sort(F.array_union("base", F.coalesce(
        "more", F.array().cast("array<string>"))))
    return rows.drop("blocks").join(best, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(named, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0)))
        .alias("score"))
