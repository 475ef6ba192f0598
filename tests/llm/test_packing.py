import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strataform.llm import packing, queries, subwords

from tests.llm.test_byte_bpe import strange_texts

WORDS = public_tokenizers.path(queries.WORDS)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_cached_parts_give_the_librarys_ids(library):
    encoder = subwords.word_bpe(WORDS)
    texts = strange_texts(300) + ["I'm İstanbul's ½ ² été ΣΑΣ", "<|endoftext|> hi",
                                  "_a_b__ 'S 'RE it'LL ...", "", "a" * 2000]
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode_batch(texts)]
    assert got == [library(t) for t in texts]


def test_every_token_is_what_its_text_encodes_to():
    """The condition under which ranks replace the listed merges."""
    encoder = subwords.word_bpe(WORDS)
    for piece, i in list(encoder.ranks.items())[512::97]:
        if piece.endswith(b" ") and b" " not in piece[:-1]:
            try:
                text = piece.decode()
            except UnicodeDecodeError:
                continue
            assert encoder.fast.encode_ordinary(text) == [i]


def check(rows, texts, library, window):
    ids = {}
    for doc, text in texts:
        ids.setdefault(doc, []).append(library(text or "") + [2])
    total = sum(len(x) for xs in ids.values() for x in xs)
    sequences = {}
    for r in rows:
        assert any(len(x) == r.doc_tokens and zlib.crc32(
            np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
            for x in ids[r.doc_id])
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    lengths = []
    for key in sorted(sequences):
        at = 0
        for offset, length in sorted(sequences[key]):
            assert offset == at and length > 0
            at += length
        lengths.append(at)
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(x == window for x in lengths[:-1]) and sum(lengths) == total
    for doc, xs in ids.items():
        pieces = sorted((r.start, r.length) for r in rows if r.doc_id == doc)
        assert sum(n for _, n in pieces) == sum(map(len, xs))


@pytest.mark.parametrize("window", [7, 4096])
def test_edge_rows_are_packed_whole(edge_docs, library, window):
    texts = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    check(packing.pack(edge_docs, WORDS, window=window).collect(), texts, library, window)


def test_no_rows(no_docs):
    assert packing.pack(no_docs, WORDS).count() == 0


def test_long_texts_are_encoded_a_few_at_a_time(monkeypatch):
    """What is encoded at once is bounded by its size, not by its number of rows."""
    import pyarrow as pa

    most = []

    class Encoder:
        dtype = np.dtype("<u2")

        def encode_batch(self, texts):
            most.append(sum(map(len, texts)))
            return [np.asarray([len(t) % 100], "<u2").tobytes() for t in texts]

    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):  # noqa: N802
            n = 40
            batch = pa.RecordBatch.from_arrays(
                [pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int32()),
                 pa.array(["x" * 300_000] * n)], names=["doc_id", "part", "text"])
            return pa.Table.from_batches(list(run(iter([batch]))))

    monkeypatch.setattr(packing.subwords, "word_bpe", lambda _: Encoder())
    monkeypatch.setattr(packing, "scratch_table", lambda df, _: df)
    monkeypatch.setattr(packing.F, "spark_partition_id", lambda: packing.F)
    monkeypatch.setattr(packing.F, "col", lambda _: packing.F)
    for name in ("cast", "alias"):
        monkeypatch.setattr(packing.F, name, lambda _: packing.F, raising=False)
    out = packing.tokenised(Rows(), "words", 2)
    assert out.column("doc_id").to_pylist() == list(range(40))
    assert out.column("before").to_pylist() == list(range(0, 80, 2))
    assert max(most) <= 2 << 20 and sum(most) == 40 * 300_000
