import os

import duckdb
import pytest

from regiocast.llm import licenses as lic
from regiocast.llm.queries import ORACLE_SQL, op7_license_scan

#: Published licence texts, where the system has them.
SHELF = "/usr/share/common-licenses"
LONG = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
SMALL = "/root/testdata/sf0.01"
MIT = next(text for name, text in lic.KNOWN if name == "MIT" and "Permission" in text)


def scan(spark, rows, known=lic.KNOWN):
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, license string, n_notices int")
    found = known if known is lic.KNOWN else spark.createDataFrame(known, "license string, text string")
    return lic.scan(df, lic.known_digests(spark, found)).collect()


def test_forms_that_count_as_equal(spark):
    variants = [
        MIT,
        MIT.upper(),
        MIT.replace("\n\n", "\n").replace(",", " ;"),
        MIT.replace("Copyright (c) <year> <copyright holders>", "/* Copyright 2019-2024 Some Body */\n# (c) another"),
        MIT.replace("sublicense", "sub-licence").replace("MERCHANTABILITY", "MERCHANTIBILITY"),
        MIT.replace("MIT License", "MIT Licence").replace("COPYRIGHT HOLDERS", "copyright\tholders"),
    ]
    got = scan(spark, list(enumerate(variants)))
    assert all((r.whole_license, r.licenses) == ("MIT", ["MIT"]) for r in got) and len(got) == 6
    changed = scan(spark, [(0, MIT.replace("without restriction", "with restrictions")), (1, MIT + " Or not.")])
    assert all(r.whole_license is None and r.licenses == [] for r in changed)


def test_notices_in_lines(spark):
    text = "Some prose.\n** licenced under the apache licence, ver 2.0 **\nmore\nAll rights reserved\nLicensed  under CC-BY-NC 4.0!"
    (r,) = scan(spark, [(1, text)])
    assert (r.whole_license, r.licenses, r.n_notices) == (None, ["Apache-2.0", "CC-BY-NC-4.0", "all-rights-reserved"], 3)


def test_openings_lose_no_form():
    """Every spelling of a canonical phrase opens like it."""
    for first, others in lic.EQUIVALENT:
        assert all(o.replace(" ", "")[:3] == first[:3] for o in others) and len(first) > 3


def test_texts_behind_copyright_lines(spark):
    notice = "Released under the MIT License."
    heads = ["Copyright 2020 me", "  ** (C) me", "© 2021", "====\n# copyright x\n\n(c) y", "\n\n-- \nCOPYRIGHT"]
    got = scan(spark, [(i, f"{h}\n{notice}") for i, h in enumerate(heads)])
    assert [r.whole_license for r in got] == ["MIT"] * len(heads)


def test_adjacent_spellings(spark):
    (r,) = scan(spark, [(1, "licence licence licenced")], [("x", "License license licensed")])
    assert r.licenses == ["x"]


def test_cases(spark):
    notice = "Released under the MIT License."
    rows = [(None, None), (None, notice), (1, ""), (2, "\n\n"), (3, "Copyright 2020 me"), (4, f"{notice}\n{notice}"), (4, f"{notice}\n{notice}"), (4, notice), (5, "w " * 60_000 + "\n" + notice)]
    got = sorted(((r.doc_id or 0, r.text or "", r.whole_license, r.n_notices) for r in scan(spark, rows)), key=str)
    want = [(0, "", None, 0), (0, notice, "MIT", 1), (1, "", None, 0), (2, "\n\n", None, 0), (3, "Copyright 2020 me", None, 0)]
    want += [(4, notice, "MIT", 1), (4, f"{notice}\n{notice}", None, 2), (4, f"{notice}\n{notice}", None, 2), (5, rows[-1][1], None, 1)]
    assert got == sorted(want, key=str)
    assert scan(spark, []) == []
    assert [r.licenses for r in scan(spark, rows[:2], [])] == [[], []]


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    res = con.execute(ORACLE_SQL["op7_license_scan"])
    names = [d[0] for d in res.description]
    want = sorted(res.fetchall(), key=str)
    assert sorted(map(tuple, op7_license_scan(spark, SMALL).select(*names).collect()), key=str) == want
    assert sum(r[-1] for r in want) > 10


def test_whole_texts_and_notice_forms(spark):
    notices = {
        "Licensed under the MIT License.": "MIT",
        "Licensed under the GPLv3": "GPL-3.0",
        "This software is released under the BSD 3-Clause License": "BSD-3-Clause",
        "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "Distributed under the terms of the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
        "Licensed under MPL 2.0": "MPL-2.0",
    }
    texts = ["Copyright (c) 2020, Some Body\nAll rights reserved.\n\n" + lic._BSD + "\n" + "\n\n".join(f"{k}. {x}" for k, x in enumerate(lic._BSD_TERMS[:n], 1)) + "\n" + lic._DISCLAIMER for n in (2, 3)]
    texts += ["ISC License\n\nCopyright 2020 me\n\n" + lic._ISC.format("/or"), "Copyright me\n" + lic._ZLIB, lic._BOOST, lic._UNLICENSE.format("https://unlicense.org")]
    long = "A long licence of its own.\nIt has many lines."
    rows = list(enumerate([*notices, *texts, long]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    more = spark.createDataFrame([("Long-1.0", long)], "license string, text string")
    got = {r.doc_id: r for r in lic.scan(df, lic.known_digests(spark, more=more)).collect()}
    want = [*notices.values(), "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "BSL-1.0", "Unlicense", "Long-1.0"]
    assert [got[i].whole_license for i, _ in rows] == want
    assert all(name in got[i].licenses for i, name in enumerate(want))


@pytest.mark.skipif(not all(os.path.exists(f"{SHELF}/{name}") for name in LONG), reason="no published licence texts on this system")
def test_long_licences(spark, scratch):
    """Whole long texts as published, on one line, in capitals and under a copyright line; none with a word changed, none cut."""
    rows, want = [], []
    for file, name in LONG.items():
        with open(f"{SHELF}/{file}", encoding="utf-8") as source:
            text = source.read()
        words = " ".join(line for line in text.split("\n") if not line.strip().lower().startswith(("copyright", "(c)"))).split()
        for found, variant in ((name, text), (name, " ".join(words)), (name, text.upper()), (name, "Copyright 2024 me\n" + text), (None, text + " not"), (None, text[: len(text) // 2]), (None, text.replace(" not ", " ", 1))):
            rows.append((len(rows), variant))
            want.append(found)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r for r in op7_license_scan(spark, scratch).collect()}
    assert [got[i].whole_license for i, _ in rows] == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{scratch}/documents.parquet/*.parquet'")
    res = con.execute(ORACLE_SQL["op7_license_scan"])
    names = [d[0] for d in res.description]
    assert sorted(map(str, res.fetchall())) == sorted(str(tuple(got[i][n] for n in names)) for i, _ in rows)
