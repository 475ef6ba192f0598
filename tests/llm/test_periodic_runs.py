import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataform.llm import block_match, oracle, periodic_runs
from tests.llm.conftest import EDGE_ROWS, as_rows, in_duckdb

COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256"]


def plain_runs(words, min_words=12):
    """All runs (start, length, period), by trying every period."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_words, 2 * q):
                best.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def found_in(words):
    _, numbers, bounds, tops = periodic_runs.word_numbers([" ".join(words).encode()])
    return [(s, e - s, q) for s, e, q in periodic_runs.find_runs(numbers, bounds, tops).tolist()]


@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=14), st.integers(1, 9)), max_size=8))
@settings(max_examples=150, deadline=None)
def test_runs_match_trying_every_period(parts):
    words = list("".join(part * times for part, times in parts))
    assert found_in(words) == plain_runs(words)


def test_texts_of_one_group_do_not_meet():
    texts = ["a b " * 20, "a b " * 3, "", "a b " * 7 + "c"]
    _, numbers, bounds, tops = periodic_runs.word_numbers([t.encode() for t in texts])
    got = periodic_runs.find_runs(numbers, bounds, tops).tolist()
    assert got == [[0, 40, 2], [46, 60, 2]]


def test_blocks_recur_where_they_are_equal():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 3, 300)
    starts, room = np.arange(0, 250, 4), np.full(63, 20)
    # Large numbers need more primes than one.
    for scale in (1, 20_000, 500_000):
        top = np.full(63, 3 * scale)
        b, q = block_match.recurrences(values * scale, starts, room, top, 4, 8, 16)
        want = {(s, d) for s in starts.tolist() for d in range(8, 16)
                if (values[s:s + 4] == values[s + d:s + d + 4]).all()}
        assert set(zip(b.tolist(), q.tolist(), strict=True)) == want
    assert block_match.primes_needed(np.array([10, 30_000, 10 ** 9]), 4).tolist() == [1, 2, 3]


def test_edge_rows_and_clashing_names(edge_docs, no_docs):
    found = periodic_runs.runs_of(edge_docs).collect()
    want = {}
    for i, text, _ in EDGE_ROWS:
        words = (text or "").encode().split()
        # The long texts repeat only after 2 * 13 * 977 of their 40,000 words.
        runs = plain_runs(words) if len(words) < 1000 else []
        want.setdefault(i, set()).add((len(words), tuple(runs)))
    assert sorted((repr(r.doc_id) for r in found)) == sorted(repr(i) for i, *_ in EDGE_ROWS)
    for r in found:
        assert (r.n_words, tuple((x.start, x.length, x.period) for x in r.runs)) in want[r.doc_id]
    assert periodic_runs.runs_of(no_docs).count() == 0
    assert periodic_runs.run_report(periodic_runs.runs_of(
        periodic_runs.with_repeats(no_docs))).count() == 0


def test_a_long_text_of_one_word_and_a_long_period(spark):
    texts = ["same " * 60_000, " ".join(str(i % 9000) for i in range(30_000)) + " end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs.runs_of(docs).collect()}
    assert found == {0: [(0, 60_000, 1)], 1: [(0, 30_000, 9000)]}


def test_query_matches_its_sql(spark):
    texts = ["x", "", None, " a\tb \n" * 30, "one two three four five six seven " * 5,
             "a a a a a a a a a a a a b a a a a a a a a a a a a a b", "日 本 " * 9 + "語"]
    texts += [" ".join(np.random.default_rng(i).choice(list("abcdefgh"), 5 + 7 * i)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = periodic_runs.run_report(periodic_runs.runs_of(periodic_runs.with_repeats(docs)))
    want = in_duckdb(oracle.PERIODIC_RUNS, documents=docs.toPandas())
    assert as_rows(got, COLUMNS) == as_rows(want, COLUMNS)
    assert sum(r["n_runs"] > 0 for r in want) >= 6


def test_collapsed_and_longest_first(spark):
    docs = spark.createDataFrame([("k", "x " + "a b " * 8 + "y")], "doc_id string, text string")
    found = periodic_runs.runs_of(docs)
    row = found.select("collapsed", periodic_runs.longest_first(found).alias("longest")).first()
    assert row.collapsed == "x a b y"
    assert [(r.start, r.length, r.period) for r in row.longest] == [(1, 16, 2)]
    digest = periodic_runs.run_report(found).first()
    assert digest.exponent_milli == 8000
    assert digest.runs_sha256 == hashlib.sha256(b"1,16,2\n").hexdigest()


def test_smaller_runs_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(4, np.int64), np.array([0, 4]), np.array([1]), min_words=6)
