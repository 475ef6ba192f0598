import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from strataform.llm import byte_bpe, queries, subwords

RANKS = public_tokenizers.path(queries.RANKS)
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def strange_texts(n, seed=1):
    rng = random.Random(seed)
    parts = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "'re", "'", "12", "é", "ß", "日本", "🙂", "...",
             "\x00", "\x1c", " ", "　", "Ab", "'ll", "x" * 30, "!?"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(n)]


def test_cached_parts_give_the_librarys_ids(library):
    encoder = subwords.byte_bpe(RANKS, PATTERN)
    texts = strange_texts(400) + ["x" * 5000, " " * 3000, "\n" * 999 + "a"]
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode_batch(texts)]
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [encoder.decode(x).decode() for x in encoder.encode_batch(texts)] == texts


def test_stitched_chunks_give_the_librarys_ids(spark, library):
    texts = strange_texts(60, seed=2) + ["y" * 400 + " z", " " * 300, "word " * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for size, overlap in ((40, 16), (25, 5)):
        rows = byte_bpe.encode(docs, RANKS, PATTERN, size, overlap).collect()
        assert {r.doc_id: r.ids for r in rows} == {
            i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_edge_rows(edge_docs, no_docs, library):
    ids = byte_bpe.encode(edge_docs, RANKS, PATTERN)
    rows = byte_bpe.decode_column(ids, "ids", RANKS, PATTERN).select(
        "doc_id", "ids", "decoded", byte_bpe.ids_digest("ids").alias("digest")).collect()
    texts = [(r.doc_id, r.text or "") for r in edge_docs.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded).decode()) for r in rows), key=repr) == sorted(
        ((i, library.encode_ordinary(t), t) for i, t in texts), key=repr)
    assert all(r.digest == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
               for r in rows)
    assert byte_bpe.encode(no_docs, RANKS, PATTERN).count() == 0
