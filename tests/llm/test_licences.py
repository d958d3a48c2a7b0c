"""Notices in texts, wording that is no notice, paragraphs."""

import pyarrow as pa
import pytest

from jobsluice.llm import licences
from jobsluice.llm.words import texts_of


@pytest.fixture(scope="module")
def model():
    return licences.train([])


def test_families_and_lines(spark, model):
    texts = {
        1: "Some prose here.\n\nReleased under the MIT License.\nMore prose.",
        2: "Licensed under CC BY-NC 3.0.",
        3: "The fishing license was granted by the general public office, version 2.0.",
        4: "Project files. licensed under the apache license, version 2.0; see details",
        5: "This work is licensed under the GNU General Public License, version 2.\nReleased under the MIT License.",
        6: None,
        7: "",
        8: "Licensed under\nthe sun",
        9: "Licensed under CC BY-SA 4.0." + " word" * 50_000,
    }
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in texts.items()], "doc_id bigint, text string, notices string, line int")
    got = {r["doc_id"]: r for r in licences.scan(docs, model).collect()}
    found = {k: [(n["line"], n["family"]) for n in r["notices"] if n["confirmed"]] for k, r in got.items()}
    assert found == {
        1: [(2, "mit")], 2: [(0, "cc-by-nc")], 3: [], 4: [(0, "apache")], 5: [(0, "gpl"), (1, "mit")], 6: [], 7: [],
        8: [], 9: [(0, "cc-by-sa")],
    }
    assert [got[k]["n_paragraphs"] for k in (1, 5, 6, 7, 8)] == [3, 2, 0, 0, 2]


def test_own_notices_and_mentions(model):
    lines = [(n, c) for c, notices in licences.NOTICES.items() for n in notices] + [(m, "none") for m in licences.MENTIONS]
    for line, family in lines:
        hit, p, _ = model.probabilities(licences.paragraphs(texts_of(pa.array([line])))[0])
        best = model.classes[p[0].argmax()] if len(hit) and p[0].max() >= licences.LEAST else "none"
        assert best == family


def test_paragraphs_of_odd_texts():
    lines, owner = licences.paragraphs(texts_of(pa.array(["a\n\nb\n", None, "", "c"])))
    assert owner.tolist() == [0, 0, 0, 3] and len(lines) == 4


def test_empty_table(empty):
    assert licences.scan(empty).count() == 0


def test_notices_that_stand_alone(spark, model):
    texts = {
        1: "Prose.\nAll rights reserved.\nMore prose.",
        2: "Copyright 2020 Some Company. All rights reserved.",
        3: "MIT License\n\nCopyright 2020 Someone",
        4: "# GNU General Public License v3.0",
        5: "Apache License, Version 2.0",
        6: "All seats in the front row were reserved.",
        7: "In the second chapter the author compares how the MIT License came to be used by so many young companies.",
    }
    got = licences.scan(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), model).collect()
    found = {r["doc_id"]: [n["family"] for n in r["notices"] if n["confirmed"]] for r in got}
    assert found == {1: ["proprietary"], 2: ["proprietary"], 3: ["mit"], 4: ["gpl"], 5: ["apache"], 6: [], 7: []}


def test_licence_lines_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wanted = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "All rights reserved.": "proprietary",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Released under the MIT License.": "mit",
        "Licensed under the Apache License, Version 2.0.": "apache",
    }
    texts = {r["doc_id"]: (r["text"] or "").split("\n") for r in docs.select("doc_id", "text").collect()}
    lines = {(d, k, wanted[line]) for d, text in texts.items() for k, line in enumerate(text) if line in wanted}
    speaking = {(d, k) for d, text in texts.items() for k, line in enumerate(text) if "licensed under" in line.lower() or "rights reserved" in line.lower()}
    got = {(r["doc_id"], n["line"], n["family"]) for r in licences.scan(docs).collect() for n in r["notices"] if n["confirmed"]}
    assert {f for _, _, f in lines} == set(wanted.values()) and speaking <= {(d, k) for d, k, _ in lines}
    assert got == lines


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""


def test_wrapped_notices(spark, model):
    marked = lambda mark, text: "\n".join(mark + line for line in text.split("\n"))
    texts = {
        1: MIT,
        2: GPL,
        3: BSD,
        4: LGPL,
        5: "int x;\n\n" + marked("# ", GPL) + "\n#\nint y;",
        6: "/*\n" + marked(" * ", BSD) + "\n */",
        7: f"MIT License\n\nCopyright (c) 2020 Someone\n\n{MIT}\r\n\r\nmore",
        8: marked("// ", MIT) + "\n" + marked("// ", BSD),
        9: f"{GPL}\n\n{GPL}",
        10: "released\nunder\nsome\nrules the\nlibrary and the license of\nMIT",
        11: BSD.replace("\n", "\n\n"),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = licences.scan(docs, model).collect()
    found = {r["doc_id"]: [(n["line"], n["family"]) for n in r["notices"] if n["confirmed"]] for r in got}
    assert found == {
        1: [(0, "mit")], 2: [(0, "gpl")], 3: [(0, "bsd")], 4: [(0, "lgpl")], 5: [(2, "gpl")], 6: [(1, "bsd")],
        7: [(0, "mit"), (4, "mit")], 8: [(0, "mit"), (5, "bsd")], 9: [(0, "gpl"), (5, "gpl")], 10: [], 11: [],
    }


FOREIGN = [
    "Licensed under the Artistic License 2.0.",
    "Distributed under the Boost Software License, Version 1.0.",
    "Microsoft Public License 2.0",
    "Educational Community License, Version 2.0",
    "Licensed under the Mulan PSL v2 License.",
    "Released under the zlib License.",
    "SPDX-License-Identifier: Zlib",
    "This work is licensed under the GNU Free Documentation License, version 1.3.",
    "Licensed under CC BY-ND 4.0.",
    "Licensed under CC BY-NC-SA 4.0.",
    "This program and the accompanying materials are made available under the terms of the Common Public License v1.0.",
]


def _best(model, line):
    hit, p, _ = model.probabilities(licences.paragraphs(texts_of(pa.array([line])))[0])
    return (model.classes[p[0].argmax()], float(p[0].max())) if len(hit) else ("none", 1.0)


def test_other_licences_confirm_no_family(spark, model):
    docs = spark.createDataFrame(list(enumerate(FOREIGN)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["notices"] for r in licences.scan(docs, model).collect()}
    assert [n for notices in got.values() for n in notices if n["confirmed"]] == []
    unknown = [k for k, notices in got.items() if [n["family"] for n in notices] == ["unknown"]]
    assert len(unknown) >= 7


@pytest.mark.parametrize("family", ["apache", "mpl", "epl", "isc"])
def test_family_that_was_left_out(family):
    """Notices of a family that the classifier has never seen are of unknown licence, and sure enough to be reported."""
    model = licences.train([], (family,))
    named = [n for n in licences.NOTICES[family] + licences.NAMES[family] if licences._renamed(licences.np.random.default_rng(1), family, n)]
    best = [_best(model, n) for n in named]
    assert all(not model.confirmed(f, licences._PLAIN[list(n.encode())].tobytes()) for n in named for f in model.templates)
    assert sum(f == "unknown" and p >= licences.LEAST for f, p in best) >= len(named) - 1


def test_probabilities_are_calibrated(model):
    """Of all lessons, as many are right as the probabilities say."""
    taught = licences.lessons()
    x = licences._matrix(taught.held, model.features)
    scores = (x @ model.weights + model.bias) / model.temperature
    p = licences.np.exp(scores - scores.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    assert abs((p.argmax(axis=1) == taught.y).mean() - p.max(axis=1).mean()) < 0.05


def test_sample_of_other_paragraphs_reads_whole_lines(spark):
    """A long text gives no more paragraphs than a short one, and what stands late in a line counts."""
    late = "word " * 3_000 + "licensed under the"
    rows = [(1, "\n".join(["fill"] * 5_000)), (2, late), (3, "Released under the MIT License."), (4, None), (2, late)]
    got = licences.other_paragraphs(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert len(got) == licences.OTHER_LINES + 1
    assert sorted(len(g) for g in got)[-1] >= 3


def test_numbers_in_prose_are_no_unknown_licence(spark, model):
    docs = spark.createDataFrame([(1, "Call +1 (509) 555-6973 under the bridge.\n1232810148878564 of 190.137.223.204 version 2.0.")], "doc_id bigint, text string")
    assert licences.scan(docs, model).first()["notices"] == []
