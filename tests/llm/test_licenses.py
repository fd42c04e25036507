"""Canonical forms, look-ups, and odd inputs."""

from helpers import documents, odd_rows

from voltscape.llm import licenses

MIT = dict((name, text) for name, text in licenses.TEXTS)["MIT"]


def forms(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r.c for r in frame.selectExpr(f"{licenses.canonical('t')} as c").collect()]


def test_canonical(spark):
    assert forms(
        spark,
        [
            "  The LICENCE,\n\tthe licence licence!",
            "Copyright (c) 2020 Some One\nText",
            "(C) 1999-2001 X\r\nText\r\n© 2004",
            "The copyright notice of 2020 stays",
            "copyright owner OR Copyright Holder",
            "Copyright (c) Some Contributors\nCopyright <year> <holder>\ncopyright by us\nText\n(c) You must keep it",
            "",
            "É Ü 3",
        ],
    ) == [
        "the license the license license",
        "text",
        "text",
        "the copyright notice of 2020 stays",
        "copyright holder or copyright holder",
        "text c you must keep it",
        "",
        "É Ü 3",
    ]


def test_scan(spark):
    wrapped = "Copyright 2021 Someone\n\n" + MIT.replace(" ", "\n  ").replace("sublicense", "sublicence").lower()
    rows = [
        (1, wrapped, "en", "a"),
        (2, MIT + " And more.", "en", "a"),
        (3, "Text.\nLicensed under CC-BY-NC 4.0\nmore\nreleased under the mit licence\nReleased under the MIT License.", "en", "a"),
        (4, "A line that ends: Released under the MIT License.", "en", "a"),
        *[(10 + i, "All rights reserved.", "en", "a") for i in range(50)],
    ]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows), licenses.known_licenses(spark)).collect()}
    assert got[1].license_id == "MIT"
    assert got[2].license_id is None
    assert (got[3].license_id, got[3].line_licenses, got[3].n_license_lines) == (None, "CC-BY-NC-4.0,MIT", 3)
    assert (got[4].line_licenses, got[4].n_license_lines) == ("", 0)
    assert all(got[10 + i].license_id == "LicenseRef-all-rights-reserved" and got[10 + i].n_license_lines == 1 for i in range(50))


def test_odd_rows(spark):
    rows = [*odd_rows(), (20, "MIT", None, None), (21, "Licensed under CC0 1.0.", None, None), (21, "Licensed under CC0 1.0.", "x", "y")]
    known = licenses.known_licenses(spark)
    got = licenses.scan(documents(spark, rows), known).collect()
    assert len(got) == len(rows)
    assert [(r.license_id, r.n_license_lines) for r in got if r.doc_id == 21] == [("CC0-1.0", 1)] * 2
    assert len({r.digest for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert licenses.scan(documents(spark, []), known).count() == 0
    assert {r.license_id for r in licenses.scan(documents(spark, rows), known.limit(0)).collect()} == {None}


def test_whole_licenses(spark):
    """Full texts as they are passed on: titled, with a holder's line, without the appendix."""
    held = "Copyright (c) 2020 X"
    files = dict(licenses._long_texts())
    named = [(name, text) for name, text in licenses._long_texts()]
    named += [("MIT", f"MIT License\n\n{held}\n\n{MIT}"), ("MIT", f"The MIT License (MIT)\n{held}\nAll rights reserved.\n\n{MIT}")]
    named += [("BSD-2-Clause", f"BSD 2-Clause License\n\n{held}, Y\n\n{files['BSD-2-Clause']}")]
    named += [("Apache-2.0", files["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 X"))]
    named += [("Apache-2.0", files["Apache-2.0"].split("APPENDIX")[0]), ("GPL-3.0-only", files["GPL-3.0-only"].split("How to Apply")[0])]
    named += [("GPL-2.0-only", files["GPL-2.0-only"].split("Version 2, June 1991\n", 1)[1])]
    named += [("MIT", f"MIT License\n\nCopyright (c) The X Contributors\n\n{MIT}"), ("MIT", f"Copyright (c) <year> <copyright holders>\n\n{MIT}")]
    heads = {name: text for name, text in licenses.NOTICES}
    named += [(name, f"Copyright 2019 X\n\n{heads[name]}".replace(". ", ".\n")) for name in ("Apache-2.0", "GPL-3.0-or-later")]
    named += [(None, f"MIT License\n\n{held}"), (None, files["Apache-2.0"][:5000])]
    rows = [(i, text, "en", "a") for i, (_, text) in enumerate(named)]
    got = {r.doc_id: r.license_id for r in licenses.scan(documents(spark, rows), licenses.known_licenses(spark)).collect()}
    assert [got[i] for i in range(len(named))] == [name for name, _ in named]
    assert {"Apache-2.0", "GPL-2.0-only", "LGPL-3.0-only", "MPL-2.0", "BSD-2-Clause", "CC0-1.0", "Unlicense"} <= set(files)
