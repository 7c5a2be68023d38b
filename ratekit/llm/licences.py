"""Licence scan: TF-IDF cosine of headers and licence files to templates, then inheritance.

Candidates are the lines and sentences of a text that hold a licence cue, the passages of
the unwrapped text (cut at blank lines and sentence ends) that hold a cue or three of the
templates' rarer tokens, and of a licence file (by its base name) the whole text. They
are token count vectors, weighted by an inverse document frequency counted over the
lines, sentences and licence files of the corpus, and compared with the templates by
cosine through an equi-join on tokens. Whole texts, and a file's passages put together,
are compared with the full licence texts by trigrams of tokens. From ``least`` on
a template is met. A full text goes before headers, and any header before a mere
"All rights reserved"; a template with a version that the candidate does not name gives way to one
of its family with it; an SPDX line must be equal, and an SPDX expression (with AND, OR or WITH) is
the file's licence as it stands. The best candidate's licence is the
file's. Equal candidates are compared once. A file without a licence inherits
that of the licence file in its nearest ancestor directory: directories are
joined to their ancestors by path, files to their directory. The top of the tree ('')
is the last ancestor of every path. A licence file that no template meets has no
known licence, and stops the search: what lies below inherits no known licence from it. Of several
licence files in one directory the best match counts. Paths are compared without "./" and
repeated slashes.

Defined results: null or empty texts have no header and may only inherit; a null path
has no directory; paths with and without a leading slash have the same top; equal scores take the licence that sorts first; rows with equal
ids are one file (its path and candidates together); an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratekit.session import scratch_path

# Cue words of licence headers and short header texts of common licences.
CUE = r"(?i)licen[sc]e|copyright|spdx|all rights reserved|public domain|creative commons"
FILE_NAME = r"(?i)^(un)?(licen[sc]e|copying)([._-].*)?$"
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("Zlib", "SPDX-License-Identifier: Zlib"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "SPDX-License-Identifier: BSL-1.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("All-rights-reserved", "All rights reserved."),
    ("All-rights-reserved", "Copyright. All rights reserved."),
)
_TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
TEXTS = Path(__file__).parent / "licence_texts"
# A wrapped text is cut at blank lines (of a comment too) and sentence ends, not at "v. 2.0".
PASSAGE_END = r"\n(?:[^\w\n]*\n)+|(?<=[.!?])(?<!\b[vV]\.)\s+"
# Words that are no sign of a licence; the templates' others are its rarer tokens.
COMMON = frozenset(
    "a all and any anyone are as at be by can except file files following for free freely from in including international is it later "
    "library made may not of obtaining on or other person persons program published public purpose rights so source subject that the their this to under "
    "use version whom with without work you your code copy copies form forms met option fee charge deal do either above appear applications contents "
    "materials sell merge limitation available".split()
)
RARE = tuple(sorted({w for _, t in TEMPLATES for w in re.findall(_TOKEN, t.lower()) if w not in COMMON and not w[0].isdigit()}))
RARE_LEAST = 3
SPDX = r"SPDX-License-Identifier:\s*(\(*[A-Za-z0-9.+-]+\)*(?:\s+(?:AND|OR|WITH)\s+\(*[A-Za-z0-9.+-]+\)*)+)"
EXPRESSION, FULL, HEADER, NOTICE = -1, 0, 1, 2


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), 0)


def _directory(path: Column) -> Column:
    """The path without its last part; '' at the top, null for a null path."""
    plain = F.regexp_replace(F.regexp_replace(path, r"/(?:\.?/)+", "/"), r"^\./", "")
    return F.regexp_replace(plain, r"/*[^/]*$", "")


def _is_licence_file() -> Column:
    return F.coalesce(F.regexp_extract("path", r"[^/]*$", 0).rlike(FILE_NAME), F.lit(False))


def _table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _rare(text: Column) -> Column:
    """Number of different rarer tokens of the templates in ``text``."""
    words = F.split(F.lower(text), r"[^a-z0-9.-]+|[.-](?=[^a-z0-9]|$)")
    return F.size(F.array_intersect(words, F.array(*map(F.lit, RARE))))


def _trigrams(text: Column) -> Column:
    """Three tokens from each token on; fewer at the end."""
    words = _tokens(text)
    # zipped, as a lambda over positions would cut the text anew at each
    rest = [F.slice(words, k, F.greatest(F.size(words), F.lit(1))) for k in (1, 2, 3)]
    return F.transform(F.arrays_zip(*(r.alias(n) for r, n in zip(rest, "abc"))), lambda x: F.concat_ws(" ", x["a"], x["b"], x["c"]))


def _full(passages: DataFrame, least: float) -> DataFrame:
    """id, named, family, late, b of the candidates that hold a licence's whole text: cosine of token trigrams."""
    spark = passages.sparkSession
    # the licence texts are a fixed list: a proven bound
    full = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt"))]
    t = spark.createDataFrame(full, "licence string, text string").select("licence", F.explode(_trigrams(F.col("text"))).alias("gram"))
    t = t.groupBy("licence", "gram").agg(F.count(F.lit(1)).alias("tf"))
    idf = t.groupBy("gram").agg((F.log(F.lit(1.0 + len(full)) / (1.0 + F.count(F.lit(1)))) + 1.0).alias("w"))
    t = t.join(idf, "gram").withColumn("v", F.col("tf") * F.col("w"))
    t = t.withColumn("norm", F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy("licence"))))
    t = t.groupBy("gram").agg(F.first("w").alias("w"), F.collect_list(F.struct("licence", (F.col("v") / F.col("norm")).alias("tv"))).alias("ts"))
    key = ["k1", "k2"]
    keyed = passages.select("id", "named", "text", *(F.xxhash64(F.lit(n), "text").alias(k) for n, k in enumerate(key)))
    h = keyed.groupBy(key).agg(F.first("text").alias("text")).select(*key, F.explode(_trigrams(F.col("text"))).alias("gram"))
    h = h.groupBy(*key, "gram").agg(F.count(F.lit(1)).alias("tf")).join(F.broadcast(t), "gram", "left")
    h = h.withColumn("v", F.col("tf") * F.coalesce("w", F.lit(math.log(1.0 + len(full)) + 1.0)))
    norms = h.groupBy(key).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dots = h.filter("ts IS NOT NULL").select(*key, "v", F.inline("ts")).groupBy(*key, "licence").agg(F.sum(F.col("v") * F.col("tv")).alias("dot"))
    scored = dots.join(norms, key).select(*key, "licence", F.round(F.col("dot") / F.col("norm"), 9).alias("score")).filter(F.col("score") >= least)
    best = scored.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("m"))
    b = F.struct(F.lit(FULL).alias("rank"), F.col("m.s").alias("s"), F.col("m.licence").alias("licence"))
    return keyed.join(best, key).select("id", "named", F.lit("").alias("family"), F.lit(False).alias("late"), b.alias("b"))


def _own(files: DataFrame, least: float) -> DataFrame:
    """id, licence, score, kind of the files with a matching candidate."""
    spark = files.sparkSession
    named = _is_licence_file()
    cued = files.withColumn("rare", _rare(F.col("text"))).filter(F.col("text").rlike(CUE) | (F.col("rare") >= RARE_LEAST) | (named & F.col("text").isNotNull()))
    sentences = F.filter(F.split("text", r"\n|(?<=[.!?])\s+"), lambda s: s.rlike(CUE))
    passages = F.filter(F.split("text", PASSAGE_END), lambda s: s.rlike(CUE) | (_rare(s) >= RARE_LEAST))
    whole = F.when(named, F.array("text")).otherwise(F.array().cast("array<string>"))
    cued = cued.select("id", "text", "rare", named.alias("named"), F.array_distinct(F.concat(sentences, whole)).alias("lines"), F.array_distinct(passages).alias("passages"))
    # Read several times below: the texts are scanned once.
    cued = _table(cued, "licence-candidates")
    # Passages that are no line of their own are compared too, but counted for no weight.
    both = F.concat(
        F.transform("lines", lambda x: F.struct(x.alias("header"), F.lit(True).alias("counted"))),
        F.transform(F.array_except("passages", "lines"), lambda x: F.struct(x.alias("header"), F.lit(False).alias("counted"))),
    )
    found = cued.select("id", "named", F.inline(both))
    found = found.select("id", "named", "counted", F.concat_ws(" ", F.array_sort(_tokens(F.col("header")))).alias("words")).filter("words <> ''")
    found = _table(found, "licence-headers")
    # Candidates go by a 128-bit hash of their words: a whole licence file is no join key.
    key = ["k1", "k2"]
    keyed = found.select("id", "named", "counted", "words", *(F.xxhash64(F.lit(n), "words").alias(k) for n, k in enumerate(key)))
    headers = keyed.groupBy(key).agg(F.sum(F.col("counted").cast("long")).alias("n"), F.first("words").alias("words"))
    tf = headers.select(*key, "n", F.explode(F.split("words", " ")).alias("token")).groupBy(*key, "n", "token").agg(F.count(F.lit(1)).alias("tf"))
    total = headers.agg(F.sum("n").alias("total")).scalar()
    df = tf.groupBy("token").agg(F.sum("n").alias("df"))
    weight = F.ln((1.0 + F.coalesce(total, F.lit(0))) / (1.0 + F.coalesce(F.col("df"), F.lit(0)))) + 1.0
    # the templates are a fixed list: a proven bound; an SPDX line is its identifier
    temp = spark.createDataFrame([(k, a, t, t.startswith("SPDX")) for k, (a, t) in enumerate(TEMPLATES)], "template int, licence string, words string, spdx boolean")
    temp = temp.select("template", "licence", "spdx", F.explode(_tokens(F.col("words"))).alias("token")).groupBy("template", "licence", "spdx", "token").agg(F.count(F.lit(1)).alias("tf"))
    idf = df.withColumn("w", weight).select("token", "w")
    unseen = F.ln(1.0 + F.coalesce(total, F.lit(0))) + 1.0
    t = temp.join(idf, "token", "left").withColumn("v", F.col("tf") * F.coalesce("w", unseen))
    # what a template says about the version: numbers, or all of an SPDX line
    t = t.withColumn("exact", (F.col("spdx") | F.col("token").rlike("^[0-9]")).cast("int"))
    by = Window.partitionBy("template")
    t = t.withColumn("norm", F.sqrt(F.sum(F.col("v") * F.col("v")).over(by))).withColumn("asked", F.sum("exact").over(by))
    t = t.select("token", "template", "licence", "spdx", "exact", "asked", (F.col("v") / F.col("norm")).alias("tv"))
    h = tf.join(idf, "token").withColumn("v", F.col("tf") * F.col("w"))
    norms = h.groupBy(key).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dots = h.join(F.broadcast(t), "token").groupBy(*key, "template", "licence", "spdx", "asked").agg(F.sum(F.col("v") * F.col("tv")).alias("dot"), F.sum("exact").alias("met"))
    dots = dots.withColumn("late", F.col("met") < F.col("asked")).filter("NOT (spdx AND late)")
    scored = dots.join(norms, key).select(*key, "licence", "late", F.round(F.col("dot") / F.col("norm"), 9).alias("score")).filter(F.col("score") >= least)
    # the smallest struct: highest score, then first licence; of a family, one whose version is met
    rank = F.when(F.col("licence") == "All-rights-reserved", NOTICE).otherwise(HEADER)
    scored = scored.withColumn("family", F.regexp_replace("licence", r"-[0-9.]+$", "")).withColumn("b", F.struct(rank.alias("rank"), (-F.col("score")).alias("s"), "licence"))
    best = scored.groupBy(*key, "family", "late").agg(F.min("b").alias("b"))
    hits = keyed.select("id", "named", *key).join(best, key).select("id", "named", "family", "late", "b")
    # whole texts: a licence file's, and the passages of any file put together
    parts = F.when(F.col("named"), F.array("text", F.array_join("passages", "\n"))).otherwise(F.array(F.array_join("passages", "\n")))
    texts = cued.filter(F.col("rare") >= RARE_LEAST).select("id", "named", F.explode(F.array_distinct(parts)).alias("text"))
    hits = hits.unionByName(_full(texts, least))
    stated = F.explode(F.regexp_extract_all("text", F.lit(SPDX), 1)).alias("said")
    said = F.regexp_replace("said", r"\s+", " ")
    b = F.struct(F.lit(EXPRESSION).alias("rank"), F.lit(-1.0).alias("s"), said.alias("licence"))
    expressions = cued.select("id", "named", stated).select("id", "named", F.lit("").alias("family"), F.lit(False).alias("late"), b.alias("b"))
    hits = hits.unionByName(expressions)
    one = hits.groupBy("id", "family").agg(F.min(F.struct("late", "b")).alias("m"), F.max("named").alias("named"))
    one = one.groupBy("id").agg(F.min("m.b").alias("b"), F.max("named").alias("named"))
    kind = F.when(F.col("named"), "file").otherwise("header")
    return one.select("id", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"), kind.alias("kind"))


def scan(files: DataFrame, least: float = 0.6) -> DataFrame:
    """id, path, licence, score, kind (header, file, inherited or null), origin of every row.

    ``files``: id, path, text. ``origin`` is the directory that an inherited licence comes from.
    """
    files = files.select("id", "path", "text")
    rows = files.select("id", "path")
    own = _table(_own(files, least), "licence-files")
    decided = rows.join(own, "id", "left").withColumn("kind", F.coalesce("kind", F.when(_is_licence_file(), "file")))
    folder = _directory(F.col("path"))
    stated = decided.filter("kind = 'file'").select(folder.alias("folder"), "score", "licence").filter("folder IS NOT NULL")
    # a licence file without a known licence counts where no other lies beside it
    stated = stated.groupBy("folder").agg(F.min(F.struct(F.coalesce(-F.col("score"), F.lit(1.0)).alias("s"), "licence")).alias("b"))
    score = F.when(F.col("b.licence").isNotNull(), -F.col("b.s"))
    stated = stated.select("folder", F.col("b.licence").alias("given"), score.alias("given_score"))
    # every directory and the ancestors of it, itself included; the top, an ancestor of all, is one row at most and no join key
    need = decided.filter("kind IS NULL").select(folder.alias("folder")).filter("folder <> ''").distinct()
    parts = F.split("folder", "/")
    above = need.select(F.col("folder").alias("below"), F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("folder")).filter("folder <> ''")
    given = F.struct("given", "given_score", F.col("folder").alias("origin"))
    near = above.join(stated.filter("folder <> ''"), "folder").groupBy("below").agg(F.max_by(given, F.length("folder")).alias("g"))
    top = stated.filter("folder = ''").agg(F.first(given).alias("top"))  # always one row
    out = decided.join(near, folder == F.col("below"), "left").crossJoin(F.broadcast(top))
    out = out.withColumn("g", F.when(F.col("path").isNotNull(), F.coalesce("g", "top")))
    mine = F.col("kind").isNotNull()
    return out.select(
        "id",
        "path",
        F.when(mine, F.col("licence")).otherwise(F.col("g.given")).alias("licence"),
        F.when(mine, F.col("score")).otherwise(F.col("g.given_score")).alias("score"),
        F.when(mine, F.col("kind")).when(F.col("g").isNotNull(), "inherited").alias("kind"),
        F.when(~mine, F.col("g.origin")).alias("origin"),
    )


def document_files(documents: DataFrame, folder: int = 64) -> DataFrame:
    """Documents as files of a tree by source and id, since the table has no paths.

    /source/k/j/: k counts 8 x ``folder`` ids, j counts ``folder`` ids; the first document of
    a folder stands for a licence file if it has a cue word, the others are <doc_id>.txt. It lies one folder up,
    in /source/k/, where it is the first of a k, and in /source/ where it is the first of
    eight k, so that nearer and farther licences compete.
    """
    i = F.col("doc_id")
    cue = F.coalesce(F.col("text").rlike(CUE), F.lit(False))
    first = (i % folder == 0) & cue
    name = F.when((i % (64 * folder) == 0) & cue, F.concat(F.lit("LICENSE-"), i.cast("string"))).when(first, "LICENSE").otherwise(F.concat(i.cast("string"), F.lit(".txt")))
    k = F.when(i % (64 * folder) != 0, F.floor(i / (8 * folder)).cast("string"))
    j = F.when(i % (8 * folder) != 0, F.floor(i / folder).cast("string"))
    parts = (F.coalesce("source", F.lit("unknown")), k, j, name)
    # concat_ws leaves out the levels above which a file lies
    path = F.when(i.isNotNull(), F.concat(F.lit("/"), F.concat_ws("/", *parts)))
    return documents.select(i.alias("id"), path.alias("path"), "text")
