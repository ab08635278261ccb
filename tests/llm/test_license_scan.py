import textwrap

from llm_fixtures import edge_docs, no_docs, small_docs  # noqa: F401

from repotrend.llm import license_scan as ls


def test_equivalent_texts_match_and_parts_do_not(spark, edge_docs, no_docs):
    docs = [
        (1, "LICENSED under the apache licence -- version 2.0!"),
        (2, "Intro.\nReleased under the MIT License.\nreleased under the mit licence\nEnd."),
        (3, "Software released under the MIT License."),
        (4, "Copyright (c) 2020 Somebody\n\n" + ls.MIT.upper()),
        (5, None), (6, "Copyright 2020"), (None, "Licensed under CC BY-NC 4.0."), (None, "Licensed under CC BY-NC 4.0."),
    ]
    found = ls.licences(spark.createDataFrame(docs, "doc_id long, text string"), ls.known_licences(spark))
    rows = {(r.doc_id, r.license): (r.whole, r.n_lines, r.first_line) for r in found.collect()}
    assert rows == {(1, "Apache-2.0"): (True, 1, 1), (2, "MIT"): (False, 2, 2), (4, "MIT"): (True, 0, None), (None, "CC-BY-NC-4.0"): (True, 2, 1)}
    assert ls.licences(edge_docs, ls.known_licences(spark)).count() == 0
    assert ls.licences(no_docs, ls.known_licences(spark)).count() == 0


def test_plan_is_native(spark, small_docs):
    plan = ls.licences(small_docs, ls.known_licences(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def every_text():
    return [("MIT", ls.MIT), ("ISC", ls.ISC), *ls.full_texts()]


def matched(spark, docs):
    found = ls.licences(spark.createDataFrame(docs, "doc_id long, text string"), ls.known_licences(spark))
    got = {}
    for r in found.where("whole").collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    return got


def test_known_texts_however_wrapped(spark):
    docs, want = [], {}
    for name, text in every_text():
        for form in (text, " ".join(text.split()), *(textwrap.fill(" ".join(text.split()), w, break_long_words=False, break_on_hyphens=False) for w in (30, 47, 72, 78, 79, 100))):
            want[len(docs)] = {name}
            docs.append((len(docs), form))
    got = matched(spark, docs)
    assert {i: (want[i], docs[i][1][:60], docs[i][1].count("\n")) for i in want if got.get(i) != want[i]} == {}
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense"} <= {n for n, _ in every_text()}


def test_titles_and_copyright_statements(spark):
    texts = dict(reversed(every_text()))
    bsd = texts["BSD-3-Clause"].split("reserved.", 1)[1]
    docs = [
        ("MIT", "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + ls.MIT),
        ("MIT", "The MIT License (MIT)\n\nCopyright © 2020-2022 A, Inc. and B <b@x.org>\nCopyright (c) 2023 C\n\n" + ls.MIT),
        ("MIT", "Copyright (c) 2020 X. " + " ".join(ls.MIT.split())),
        ("MIT", "Copyright Some Body\n\n" + ls.MIT),
        ("ISC", "ISC License\n\nCopyright 2020 Some Body\n\n" + ls.ISC),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Some Body\nAll rights reserved.\n" + bsd),
        ("BSD-3-Clause", "Copyright (c) 2020, Some Body" + bsd),
        ("Apache-2.0", texts["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 Some Body")),
        (None, "MIT License\n\n" + ls.MIT.replace("copyright notice and this permission notice shall", "notice may")),
        (None, ls.ISC.replace("copyright notice and this permission notice appear in all copies", "")),
        (None, "Released under the MIT License.\nCopyright 2020 X, you may not use this."),
    ]
    got = matched(spark, [(k, t) for k, (_, t) in enumerate(docs)])
    assert got == {k: {name} for k, (name, _) in enumerate(docs) if name}
