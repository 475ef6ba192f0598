import duckdb
import pytest

from strataform.llm.common import ship_package

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977} und{i % 13}." for i in range(20_000))

#: Nulls, empty and very long texts, ties, repeated rows, a null id.
EDGE_ROWS = [
    (1, "The same text, of more than five words. Licensed under CC BY 4.0.", "en"),
    (1, "The same text, of more than five words. Licensed under CC BY 4.0.", "en"),
    (7, "The same\ttext,  of more than five words. Licensed under\nCC BY 4.0.", None),
    (None, "the same text, of more than five words. licensed under cc by 4.0.", "en"),
    (2, None, "en"),
    (3, "", "de"),
    (4, " \t\n ", "fr"),
    (5, LONG, "de"),
    (6, LONG + " one two", "de"),
    (8, "a", "en"),
    (9, "1234 5678!", "es"),
    (10, "MIT license mit LICENSE, gnu general\npublic license; all rights reserved", "en"),
    (11, "日本語 テキスト 🙂 K x\x00y \\ <|im_end|>", None),
]

#: Names that the operators use inside.
CLASHES = ["row", "_row", "_id", "_key", "_text", "node", "n", "hi", "lo", "sha", "check", "bucket",
           "ids", "part", "before", "score", "rank", "key", "lower", "base", "c0", "p0", "s"]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge rows with further columns of clashing names, over a few partitions."""
    schema = "doc_id bigint, text string, lang string, " + ", ".join(f"`{c}` int" for c in CLASHES)
    rows = [(*r, *[i if i % 2 else None for i in range(len(CLASHES))]) for r in EDGE_ROWS]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


def in_duckdb(statement, **tables):
    """Rows of a statement over pandas frames, as dictionaries."""
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    found = con.execute(statement)
    names = [c[0] for c in found.description]
    return [dict(zip(names, r, strict=True)) for r in found.fetchall()]


def as_rows(frame, columns):
    """Comparable rows of a DataFrame or list of dictionaries."""
    rows = frame if isinstance(frame, list) else [r.asDict() for r in frame.collect()]
    return sorted((tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in columns)
                   for r in rows), key=repr)
