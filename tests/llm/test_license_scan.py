from tests.llm.conftest import as_rows, in_duckdb

from strataform.llm import license_scan, oracle

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_edge_rows_match_sql(edge_docs):
    frame = edge_docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"})
    # The statement groups by id: give repeated rows and the null id ids of their own.
    frame["doc_id"] = range(len(frame))
    docs = edge_docs.sparkSession.createDataFrame(frame[["doc_id", "text"]].assign(
        text=frame["text"].where(frame["text"].notna(), None)), "doc_id bigint, text string")
    assert as_rows(license_scan.scan(docs), COLUMNS) == as_rows(
        in_duckdb(oracle.LICENSE_SCAN, documents=frame), COLUMNS)
    assert license_scan.scan(edge_docs).count() == edge_docs.count()


def test_labels_and_places(spark):
    rows = [
        (1, "see the MIT-License, and: cc/by; cc by cc by"),
        (2, "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met:"),
        (3, "redistribution of binary forms"),
        (4, "licensed, under. the apache\n license, version 2.0"),
        (5, "xmit license mit licenses apachelicense"),
        (6, "Permission is granted, free of charge, to any person obtaining a copy of this software "
            "and the associated documentation files"),
    ]
    got = {r.doc_id: r for r in license_scan.scan(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (
        4, 2, 9, "cc-by,mit")
    assert got[2].labels == "bsd" and got[2].score == 1.0 and got[2].first_word is None
    assert got[3].labels == "" and got[3].score == 0.0
    assert got[4].base_labels == "apache"
    assert got[5].n_base == 0
    assert got[6].labels == "mit-grant" and 0.8 <= got[6].score < 1


def test_no_rows(no_docs):
    assert license_scan.scan(no_docs).count() == 0


def test_only_dataframe_functions(edge_docs):
    plan = license_scan.scan(edge_docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow"))


def test_first_place_behind_supplementary_characters(spark):
    rows = [(1, "\U0001F642\U0001F642\U0001F642 mit license"), (2, "a \U0001F642! b mit license, mit license")]
    got = {r.doc_id: (r.first_word, r.last_word) for r in license_scan.scan(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (1, 1), 2: (3, 5)}


#: Notices as they stand in files, wrapped over lines.
WRAPPED = {
    "mit-grant": "Copyright (c) 2020 A Name\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
                 "of this software and associated documentation files (the \"Software\"), to deal\nin the Software "
                 "without restriction.",
    "bsd": "/*\n * Redistribution and use in source and binary forms, with or without\n * modification, are permitted "
           "provided that the following conditions\n * are met:\n *\n * 1. Redistributions of source code",
    "mpl-2.0": "# This Source Code Form is subject to the terms of the Mozilla Public\r\n# License, v. 2.0. If a copy "
               "of the MPL was not distributed with this\r\n# file, You can obtain one.",
    "apache-2.0": "Licensed under the Apache License,\nVersion 2.0 (the \"License\");\nyou may not use this file",
}


def test_wrapped_notices(spark):
    import pandas as pd

    rows = [(i, text, label) for i, (label, text) in enumerate(sorted(WRAPPED.items()))]
    # A sentence end, a blank line and a blank line of spaces each part the words.
    cut = [(10, "released under. the mit\n\nsoftware license", ""),
           (11, "all rights\n \t\nreserved", ""), (12, "all rights\nreserved", "all-rights-reserved"),
           (13, "all rights;\treserved", ""), (14, "all rights;reserved", "all-rights-reserved")]
    frame = pd.DataFrame([r[:2] for r in rows + cut], columns=["doc_id", "text"])
    found = license_scan.scan(spark.createDataFrame(frame))
    labels = {r.doc_id: set(r.labels.split(",")) for r in found.collect()}
    assert all(label in labels[i] for i, _, label in rows)
    assert all(labels[i] == {label} for i, _, label in cut)
    assert as_rows(found, COLUMNS) == as_rows(in_duckdb(oracle.LICENSE_SCAN, documents=frame), COLUMNS)
