"""Licences of ordinary trees: the top directory, wrapped headers and full texts."""

import pytest

from ratekit.llm import licences

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."


def _licences(spark, rows):
    df = spark.createDataFrame(rows, "id long, path string, text string")
    return {r["id"]: (r["licence"], r["kind"], r["origin"]) for r in licences.scan(df).collect()}


# -- the top of the tree -----------------------------------------------------


@pytest.mark.parametrize("top", ["LICENSE", "/LICENSE"])
def test_the_top_passes_its_licence_on(spark, top):
    head = top[:-7]
    rows = [(1, top, MIT), (2, head + "src/a/t.py", "x"), (3, head + "t.py", None), (4, head + "lib/COPYING", GPL), (5, head + "lib/u/v.py", ""), (6, None, "x")]
    got = _licences(spark, rows)
    assert got[2] == got[3] == ("MIT", "inherited", "")
    assert got[5] == ("GPL-3.0", "inherited", head + "lib") and got[6] == (None, None, None)


def test_a_tree_without_a_top_licence_gives_none(spark):
    assert _licences(spark, [(1, "/a/LICENSE", MIT), (2, "/b/t.py", "x"), (3, "t.py", "x")])[2] == (None, None, None)


# -- wrapped headers and full texts --------------------------------------------


def _gnu(kind, subject, version):
    return (
        f"/*\n * This {subject} is free software; you can redistribute it and/or modify\n * it under the terms of the GNU {kind}General Public\n * License as published by the Free Software\n"
        f" * Foundation; either version\n * {version} of the License, or (at your option) any later version.\n */\nint main;\n"
    )


def _comment(text):
    return "\n".join("# " + x for x in text.split("\n")) + "\nimport os\n"


def test_wrapped_headers_keep_their_version(spark):
    bsd = (licences.TEXTS / "BSD-3-Clause.txt").read_text()
    wants = {
        _gnu("", "program", 2): "GPL-2.0", _gnu("", "program", 3): "GPL-3.0", _gnu("Lesser ", "library", "2.1"): "LGPL-2.1", _gnu("Lesser ", "library", 3): "LGPL-3.0",
        _gnu("Affero ", "program", 3): "AGPL-3.0", "// under the GNU General Public License\n// version 3.\n": "GPL-3.0",
        "# Copyright 2020 Some One. All rights reserved.\n#\n# Redistribution and use in source and binary forms, with or\n# without modification, are permitted provided that the following\n# conditions are met:\n": "BSD-3-Clause",
        _comment(bsd): "BSD-3-Clause", _comment((licences.TEXTS / "BSD-2-Clause.txt").read_text()): "BSD-2-Clause", "SPDX-License-Identifier: Unheard-Of-1.0": None,
        "x\n\nAll rights reserved.\n": "All-rights-reserved", "Licensed soup recipes of the many people of the village, version 3.": None,
    }
    got = _licences(spark, [(i, f"/p/{i}.c", t) for i, t in enumerate(wants)])
    assert [got[i][0] for i in range(len(wants))] == list(wants.values())


def test_full_texts_have_their_names(spark):
    names = sorted(p.stem for p in licences.TEXTS.glob("*.txt"))
    rows = [(i, f"/{n}/{f}", "Copyright 2020 A. Person\n\n" + (licences.TEXTS / f"{n}.txt").read_text()) for i, n in enumerate(names) for f in ["COPYING"]]
    got = _licences(spark, rows + [(-1, "/x/LICENSE", "The cook and the people of the village say that it is the time of the year to eat. " * 40)])
    assert {n: got[i][:2] for i, n in enumerate(names)} == {n: (n, "file") for n in names}
    assert got[-1][0] is None


# -- the layout of the documents -------------------------------------------------


def test_nearer_and_farther_licences_compete_in_the_layout(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    texts = {0: MIT, 512: GPL, 576: apache}
    ids = [*texts, 1, 513, 577, 640, 641, 1025]
    df = spark.createDataFrame([(i, texts.get(i, "x"), "web") for i in ids] + [(514, "x", None), (None, "x", "web")], "doc_id long, text string, source string")
    files = licences.document_files(df)
    paths = {r["id"]: r["path"] for r in files.collect()}
    assert [paths[i] for i in (0, 512, 576, 1)] == ["/web/LICENSE-0", "/web/1/LICENSE", "/web/1/9/LICENSE", "/web/0/0/1.txt"]
    assert [paths[i] for i in (640, 1025)] == ["/web/1/10/640.txt", "/web/2/16/1025.txt"]  # 640 has no cue word
    got = {r["id"]: (r["licence"], r["origin"]) for r in licences.scan(files).collect()}
    assert got[577] == ("Apache-2.0", "/web/1/9") and got[513] == got[641] == ("GPL-3.0", "/web/1")
    assert got[1] == got[1025] == ("MIT", "/web") and got[514] == got[None] == (None, None)
