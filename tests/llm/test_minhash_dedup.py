import random
import re
from itertools import combinations

import numpy as np

from strataform.llm import minhash_dedup

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def plain(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i)
               and rows[j][0] is not None] if sets[i] else [doc]
        smallest = min(ids, default=None)
        out.append((doc, len(sets[i]), smallest, doc == smallest))
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect()),
                  key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(30, 120))
        rows.append(base)
        for _ in range(rng.randint(0, 6)):  # copies with ever more changes
            base = list(base)
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            rows.append(base)
    passage = rng.choices(vocabulary, k=60)  # shared by different texts
    rows += [rng.choices(vocabulary, k=25) + passage for _ in range(10)]
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_groups_match_all_pairs(spark):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(minhash_dedup.near_duplicates(docs)) == plain(rows)


def test_edge_rows_match_the_plain_version(edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert found(minhash_dedup.near_duplicates(edge_docs)) == plain(rows)
    kept = minhash_dedup.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    # One row a group, and every text without words.
    groups = {c for _, n, c, _ in plain(rows) if n}
    without = sum(1 for _, t in rows if not shingles(t))
    assert kept.count() == len(groups) + without


def test_no_rows(no_docs):
    assert minhash_dedup.near_duplicates(no_docs).count() == 0
    assert minhash_dedup.keep_one(no_docs).count() == 0


def test_components_match_a_search(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2050)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in minhash_dedup.connected(frame).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}


def test_sketches_differ_in_no_more_cells_than_sets_in_shingles():
    texts = [t for _, t in corpus(8)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t) for t in texts)])
    hashes, bounds = minhash_dedup.shingle_sets(data, offsets)
    cells = minhash_dedup.parity_sketches(hashes, bounds, rows=7)
    sets = [set(hashes[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    for a, b in combinations(range(len(sets)), 2):
        differ = sum(int(x).bit_count() for x in (cells[a] ^ cells[b]).view(np.uint64))
        assert differ <= len(sets[a] ^ sets[b])
        assert differ % 2 == len(sets[a] ^ sets[b]) % 2


def test_sets_are_those_of_the_words():
    texts = ["", "a b", "A  B", "a b c d e f", "a b c d e a b c d e", "x\ty\nz\x0bw v u", "é ü"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    hashes, bounds = minhash_dedup.shingle_sets(data, offsets)
    sets = [frozenset(hashes[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert sets[1] == sets[2]
    assert len(set(sets)) == len(texts) - 1
