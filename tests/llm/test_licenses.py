import random

import duckdb
import pandas as pd
import pytest

from tessera.llm import queries
from tessera.llm.licenses import TEMPLATES, Templates, find_licenses, license_report
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, alnum_words, odd_rows, with_clashes


def grams(text):
    w = alnum_words(text)
    return set(zip(w, w[1:], strict=False)) if len(w) > 1 else {(x,) for x in w}


def test_every_template_is_found_as_line_and_wrapped_paragraph(spark):
    rows, want = [], {}
    for i, (name, texts) in enumerate(TEMPLATES.items()):
        for j, text in enumerate(texts):
            doc = 10 * i + j
            words = text.split()
            wrapped = "\n".join(" ".join(words[k : k + 7]) for k in range(0, len(words), 7))
            rows += [(doc, f"Some title\n{text.upper()}\nmore text", "en", "s", 0), (500 + doc, f"intro text\n\n{wrapped}\n \t\nend", "en", "s", 0)]
            want[doc] = want[500 + doc] = name
    got = {r.doc_id: r for r in license_report(spark.createDataFrame(rows, DOCS)).collect()}
    for doc, name in want.items():
        assert name in got[doc].licenses.split(",") and got[doc].best_dice == 1.0


def test_dice_matches_brute_force(spark):
    pieces = ["Licensed under the Apache License, Version 2.0", "licensed under CC BY 4.0 or later", "All rights", "rights reserved", "Copyright 2020, all rights reserved", "under the MIT License", "Released today under the MIT License", "all rights reserved all rights reserved"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(pieces)]
    got = {(r.doc_id, r.license): r.dice for r in find_licenses(with_clashes(spark.createDataFrame(rows, DOCS)), threshold=0.6).collect()}
    want = {}
    for i, t in enumerate(pieces):
        for name, texts in TEMPLATES.items():
            d = max(2 * len(grams(t) & grams(x)) / (len(grams(t)) + len(grams(x))) for x in texts)
            if d >= 0.6:
                want[i, name] = round(d, 6)
    assert got == want and want


def test_embedded_notices_are_found_with_the_same_bounds(spark):
    mit = TEMPLATES["mit"][2].split()
    header = "# Copyright 2020 Foo\n#\n" + "\n".join("# " + " ".join(mit[k : k + 9]) for k in range(0, len(mit), 9)) + "\n#\n# The above notice is to be kept in all copies of it.\nimport os"
    texts = {
        1: ("This file is part of Foo. Licensed under CC BY 4.0. See LICENSE for details.", ["cc-by-4.0"]),
        2: (header, ["mit"]),
        3: ("Some long text of one line. Released today under the MIT License, and some more text. Text. All rights reserved. The end of it.", ["all-rights-reserved", "mit"]),
        4: ("a line with many words before the notice\nof two lines, licensed under\nthe MIT License, and so on and on and on", ["mit"]),
        5: ("Licensed for the use under all the rights of the MIT and of the License of 2020, of the reserved kind", []),
        6: ("Äpfel.\nLicensed under the MIT License.\nbananas and many other kinds of fruit", ["mit"]),
    }
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, (t, _) in texts.items()], DOCS)
    hits = find_licenses(docs).collect()
    got = {r.doc_id: r for r in license_report(docs).collect()}
    for i, (_, want) in texts.items():
        assert got[i].licenses == ",".join(want) and got[i].n_matches == len(want)
    for r in hits:
        if r.kind == "part":
            assert texts[r.doc_id][0].encode()[r.pos :].startswith(r.segment.encode())
    assert {r.kind for r in hits if r.doc_id == 6} == {"line"}  # a matching line is no part besides
    assert {r.segment for r in hits if r.doc_id == 1} == {"Licensed under CC BY 4.0"}


def test_siblings_are_told_apart(spark):
    cc = "This work is licensed under a Creative Commons {} 4.0 International License."
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    texts = {
        1: (cc.format("Attribution-NonCommercial"), "cc-by-nc-4.0"), 2: (cc.format("Attribution"), "cc-by-4.0"), 3: (cc.format("Attribution-ShareAlike"), "cc-by-sa-4.0"),
        4: (cc.format("Attribution-NonCommercial-ShareAlike"), ""), 5: (cc.format("Attribution-NoDerivatives"), ""), 6: (cc.format("Attribution").replace("4.0", "3.0"), ""),
        7: (gnu.format("", 2), ""), 8: (gnu.format("", 3), "gpl-3.0"), 9: (gnu.format("Lesser ", 3), ""),
        10: ("Licensed under CC BY-SA 4.0.", "cc-by-sa-4.0"), 11: ("Licensed under CC BY-NC-SA 4.0.", ""), 12: ("Licensed under the Apache License, Version 1.0.", ""),
    }
    rows = [(i, t, "en", "s", 0) for i, (t, _) in texts.items()]
    rows += [(100 + i, f"Some words before it, and more of them, and more of them. {t} And after it more words, and more of them.", "en", "s", 0) for i, (t, _) in texts.items()]
    got = {r.doc_id: r for r in license_report(spark.createDataFrame(rows, DOCS)).collect()}
    for i, (_, want) in texts.items():
        assert (got[i].licenses, got[i].n_matches) == (want, int(bool(want))), i
        assert (got[100 + i].licenses, got[100 + i].n_matches) == (want, int(bool(want))), i


def test_identifiers_of_source_headers(spark):
    texts = {
        1: ("// SPDX-License-Identifier: GPL-2.0-or-later\nint x;", "gpl-2.0"), 2: ("# SPDX-License-Identifier: LGPL-2.1-only", "lgpl-2.1"), 3: ("/* SPDX-License-Identifier: MIT */", "mit"),
        4: ("SPDX-License-Identifier: Foo-1.0", ""), 5: ("the SPDX-License-Identifier: line of a header", ""), 6: ("SPDX-License-Identifier: CC-BY-NC-4.0", "cc-by-nc-4.0"),
        7: ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"), 8: ("SPDX-License-Identifier: AGPL-3.0-only", "agpl-3.0"), 9: ("SPDX-License-Identifier: GPL-9.0", ""),
    }
    got = {r.doc_id: r.licenses for r in license_report(spark.createDataFrame([(i, t, "en", "s", 0) for i, (t, _) in texts.items()], DOCS)).collect()}
    assert got == {i: want for i, (_, want) in texts.items()}


def test_versions_of_the_same_notice(spark):
    notice = "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    texts = {1: (("program", "", 2), "gpl-2.0"), 2: (("program", "", 3), "gpl-3.0"), 3: (("library", "Lesser ", 2.1), "lgpl-2.1"), 4: (("program", "Lesser ", 3), "lgpl-3.0"), 5: (("program", "Affero ", 3), "agpl-3.0")}
    rows = [(i, notice.format(*x), "en", "s", 0) for i, (x, _) in texts.items()]
    rows += [(10 + i, "\n".join(" * " + " ".join(t.split()[k : k + 8]) for k in range(0, 60, 8)), *rest) for i, t, *rest in rows]
    got = {r.doc_id: r.licenses for r in license_report(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {k + i: want for i, (_, want) in texts.items() for k in (0, 10)}


def test_siblings_against_the_sql(spark, tmp_dir):
    """Lines and paragraphs in which several licences reach the threshold: the SQL states which one is chosen."""
    rows = [(10 * i + j, f"first line\n{x}\n\nlast line", "en", "s", 0) for i, (_, texts) in enumerate(TEMPLATES.items()) for j, x in enumerate(texts)]
    rows += [(1000 + d, t.replace("version 2 ", "version 4 ").replace("License", "Licence", 1).replace("4.0", "3.0"), *rest) for d, t, *rest in rows]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{tmp_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_dir}/documents.parquet/*.parquet'")
    want = con.execute(queries.oracle_sql()["op4_license_scan"]).df().sort_values("doc_id", ignore_index=True)
    whole = find_licenses(spark.read.parquet(f"{tmp_dir}/documents.parquet")).where("chosen and kind <> 'part'").groupBy("doc_id").count().collect()
    got = queries.queries()["op4_license_scan"](spark, tmp_dir).toPandas().sort_values("doc_id", ignore_index=True)
    counts = {r.doc_id: r["count"] for r in whole}
    assert [counts.get(d, 0) for d in want.doc_id] == list(want.n_matches)
    same = got.n_matches == want.n_matches  # others hold embedded notices besides, which the SQL doesn't search
    pd.testing.assert_frame_equal(got[same][list(want.columns)], want[same], check_dtype=False)
    assert same.sum() > len(rows) // 2


def test_repeated_words_take_linear_time():
    index = Templates(TEMPLATES, 0.8)
    for text in [b"all rights " * 50_000 + b"reserved", b"all rights reserved " * 30_000, b"licensed under cc by " * 30_000 + b"4 0"]:
        assert index.scan(text)


def test_windows_are_the_best_of_all():
    rng = random.Random(5)
    index = Templates({"x": ("a b c d e",), "y": ("b c a",)}, 0.8)
    for _ in range(3000):
        words = [rng.choice("abcdef") for _ in range(rng.randrange(1, 14))]
        best = 0.0
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                for t in ("a b c d e", "b c a"):
                    g, x = grams(" ".join(words[i:j])), grams(t)
                    best = max(best, 2 * len(g & x) / (len(g) + len(x)))
        found = index.windows([w.encode() for w in words])
        assert (found[0][0] if found else 0.0) == pytest.approx(best if best >= 0.8 else 0.0)


def test_odd_rows_and_empty_table(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS)
    got = license_report(docs).collect()
    assert len(got) == len(odd_rows()) and all(r.n_matches == 0 and r.licenses == "" for r in got)
    assert license_report(docs.limit(0)).collect() == []


def test_own_templates(spark):
    docs = spark.createDataFrame([(1, "do what you like with it", "en", "s", 0)], DOCS)
    assert license_report(docs, templates={"own": ("Do what you like with it!",)}).first().licenses == "own"


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.execute(queries.oracle_sql()["op4_license_scan"]).df()
    got = queries.queries()["op4_license_scan"](spark, SF_SMALL).toPandas()
    pd.testing.assert_frame_equal(got.sort_values("doc_id", ignore_index=True)[list(want.columns)], want.sort_values("doc_id", ignore_index=True), check_dtype=False)
