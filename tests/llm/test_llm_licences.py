from __future__ import annotations

from collections import Counter

from tests.llm.support import AWKWARD, documents, prose

from plumbline.llm import licences

MIT = licences.KNOWN[0][1]


def scan(spark, rows):
    found = licences.scan(documents(spark, rows), licences.known_digests(spark))
    return {r.doc_id: (r.licence, r.line_licences) for r in found.collect()}


def test_equivalent_texts_have_one_digest(spark):
    changed = "The MIT Licence" if False else "MIT Licence\n\nCopyright (c) 2001-2020 Some Body\n(C) 2020 Other\n" + MIT.split("\n", 1)[1]
    changed = changed.upper().replace(",", " ,").replace("\n", "\r\n * ") + "\nAll rights reserved."
    rows = [
        (1, MIT, None), (2, changed, None), (3, MIT + " extra", None), (4, prose(1, 50), None), (5, "licence licence", None), (6, "license license", None),
        (7, f"{prose(2, 30)}\n-- Released under the MIT licence! --\r\nLicensed under CC BY-NC 4.0.\n{prose(3, 5)}", None),
        (8, "Licensed under the Apache License, Version 2.0.", None),
        (9, "It is released under the MIT License.", None),
    ]
    got = scan(spark, rows)
    assert got == {
        1: ("MIT", ""), 2: ("MIT", ""), 3: (None, ""), 4: (None, ""), 5: (None, ""), 6: (None, ""), 7: (None, "CC-BY-NC-4.0,MIT"),
        8: ("Apache-2.0", "Apache-2.0"), 9: (None, ""),
    }
    digests = {r.doc_id: r.digest for r in licences.scan(documents(spark, rows), licences.known_digests(spark)).collect()}
    assert digests[5] == digests[6] and digests[1] == digests[2] != digests[3]


def test_conditions_keep_their_copyright_words(spark):
    text = spark.createDataFrame([("reproduce the above\ncopyright notice, this list\nCopyright 2020 X\n© Y",)], "text string")
    assert text.select(licences.canonical(text["text"])).first()[0] == "reproduce the above copyright notice this list"


def test_known_texts_differ_and_are_found(spark):
    got = scan(spark, [(k, body, None) for k, (_, body) in enumerate(licences.KNOWN)])
    assert {k: v[0] for k, v in got.items()} == {k: name for k, (name, _) in enumerate(licences.KNOWN)}


def test_awkward_rows(spark, awkward, no_documents):
    known = licences.known_digests(spark)
    got = licences.scan(awkward, known).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in AWKWARD)
    assert {(r.licence, r.line_licences) for r in got} == {(None, "")}
    assert licences.scan(no_documents, known).count() == 0
    assert licences.scan(awkward, known.limit(0)).count() == len(AWKWARD)
