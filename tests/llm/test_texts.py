"""Mixing, encoding, licences, extraction, fingerprints and the pipeline against brute force."""

import hashlib
import html as html_lib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from tokenizers import Tokenizer

import corpus_pipeline
from ratekit.llm import bpe, digest, htmltext, licences, mixing, queries
from ratekit.llm.common import as_block

SF0001, SF001 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# -- mixing ----------------------------------------------------------------


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def _oracle(sf, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted((tuple(v for _, v in sorted(zip(names, r))) for r in cur.fetchall()), key=repr)


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_mix_equals_sql(spark, sf):
    assert _rows(queries.op3_source_mix(spark, sf)) == _oracle(sf, mixing.ORACLE_SQL)


def _level(sizes, cap=3):
    """Targets by resharing the excess until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, open_ = dict.fromkeys(order, 0.0), set(order)
    left = float(sum(sizes.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if share * weight[s] > cap * sizes[s]]
        if not full:
            target |= {s: share * weight[s] for s in open_}
            break
        for s in full:
            target[s] = float(cap * sizes[s])
            left -= target[s]
            open_.remove(s)
    return target


def test_mix_targets_and_defined_results(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 5}") for i in range(200)]
    rows += [(300, "x y z", None), (301, None, None), (302, "", "s0"), (303, "one", "tiny"), (304, " ", "blank"), (None, "a b", "s1")]
    rows += [(7, "w w", "s2")] * 2
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, source string, target double")
    got = mixing.mix(df).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = _level(sizes)
    assert len(got) == len(rows)
    source = {i: s for i, _, s in rows if i != 7}
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        if r["doc_id"] in source and r["doc_id"] is not None:
            assert r["source_size"] == sizes[source[r["doc_id"]]]
            assert math.isclose(r["target"], want[source[r["doc_id"]]], abs_tol=1e-9)
        taken[round(r["target"], 6)] += r["taken"]
    total = Counter()
    for s, t in want.items():
        total[round(t, 6)] += round(t)
    assert all(abs(taken[t] - total[t]) <= 1 for t in total)
    assert _rows(mixing.mix(df.repartition(7))) == _rows(mixing.mix(df))
    assert mixing.mix(df.limit(0)).count() == 0
    copies = mixing.mixed_documents(df)
    assert copies.columns == df.columns
    assert copies.filter("text IS NULL OR trim(text) = ''").count() == 0


def test_mix_meets_its_targets_without_ids_and_with_any_column_names(spark):
    rng = random.Random(2)
    rows = [(i if i % 2 else None, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randint(1, 40))), f"s{i % 3}", i) for i in range(3000)]
    df = spark.createDataFrame([(*r, "a", "b", 1, 2, 3.0) for r in rows], "doc_id long, text string, source string, _copy int, _id string, _n string, row int, n int, key double")
    sizes, words = Counter(), Counter()
    for _, t, s, _ in rows:
        sizes[s] += len(t.split())
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    times = Counter()
    for r in out.collect():
        words[r["source"]] += len(r["text"].split())
        times[r["_copy"]] += 1
        assert (r["_id"], r["_n"], r["row"], r["n"], r["key"]) == ("a", "b", 1, 2, 3.0) and r["text"] == rows[r["_copy"]][1]
    want = _level(sizes)
    assert all(abs(words[s] - want[s]) <= 40 for s in sizes) and max(times.values()) <= 3


# -- encoding --------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, encoding="utf-8") as f:
        return bpe.Encoder(f.read())


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(["the", " and", "'s", "'LL", "  ", "\n", "\t ", "1", "²", "é", "日本", "<|endoftext|>", "<|endof", "ing", "́", "\x85", "​", "!?"]), max_size=14).map("".join))
def test_encoding_equals_the_library(encoder, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text) == ids
    assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_prefix_tokens_equal_merging(encoder):
    rng = random.Random(4)
    for _ in range(300):
        piece = "".join(rng.choices("abcdeinrst", k=rng.randint(1, 30)))
        assert list(encoder.piece(piece)) == encoder.merged(piece.encode())


def test_encoding_of_documents(spark, library):
    rows = [(1, "Hello world, hello!"), (2, None), (3, ""), (4, "a" * 30000), (4, "a" * 30000), (None, "é <|endoftext|> x")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_tokens int")
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"])) for r in bpe.encode_documents(df, VOCABULARY, with_ids=True).collect())
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[(i, len(ids), sha(",".join(map(str, ids))), sha(t or ""), tuple(ids))] += 1
    assert got == want
    assert bpe.encode_documents(df.limit(0), VOCABULARY).count() == 0


def test_full_stores_start_anew(monkeypatch):
    monkeypatch.setattr(bpe, "KEEP_PIECES", 3)
    monkeypatch.setattr(bpe, "KEEP_PAIRS", 5)
    with open(VOCABULARY, encoding="utf-8") as f:
        small = bpe.Encoder(f.read())
    small.pairs.clear()
    text = "several different words fill the stores of pieces and pairs"
    assert small.decode(small.encode(text)) == text and len(small.pieces) <= 3


# -- licences --------------------------------------------------------------


_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def _tokens(text):
    return _WORD.findall(text.lower())


def _rare_count(text):
    words = set(re.split(r"[^a-z0-9.-]+|[.-](?=[^a-z0-9]|$)", text.lower()))
    return len(words & set(licences.RARE))


def _cosine(a, b):
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    return round(sum(x * b[t] for t, x in a.items() if t in b) / norm(a) / norm(b), 9)


def _full_names(text, least):
    """(rank, -cosine, licence) of the licence texts met by trigrams."""
    grams = lambda t: Counter(" ".join(w[k : k + 3]) for w in [_tokens(t)] for k in range(len(w)))
    full = {p.stem: grams(p.read_text(encoding="utf-8")) for p in licences.TEXTS.glob("*.txt")}
    df = Counter(g for c in full.values() for g in c)
    vec = lambda c: {g: n * (math.log((1 + len(full)) / (1 + df[g])) + 1) for g, n in c.items()}
    mine = vec(grams(text))
    if not mine:
        return []
    found = [(0, -_cosine(mine, vec(c)), name) for name, c in full.items()]
    return sorted(x for x in found if -x[1] >= least)[:1]


def _own_licences(rows, least):
    """Best (rank, -score, licence) and kind of every id: lines, passages, whole texts, expressions."""
    cue = re.compile(licences.CUE, re.ASCII)
    found, hits = [], {}
    for i, path, text in rows:
        named = bool(re.match(licences.FILE_NAME, (path or "").rsplit("/", 1)[-1]))
        if text is None:
            continue
        lines = [s for s in re.split(r"\n|(?<=[.!?])[ \t\n\x0b\f\r]+", text) if cue.search(s)]
        lines = list(dict.fromkeys(lines + ([text] if named else [])))
        passages = re.split(licences.PASSAGE_END, text, flags=re.ASCII)
        passages = list(dict.fromkeys(s for s in passages if cue.search(s) or _rare_count(s) >= licences.RARE_LEAST))
        for h, counted in [(x, True) for x in lines] + [(x, False) for x in passages if x not in lines]:
            if _tokens(h):
                found.append((i, named, counted, tuple(sorted(_tokens(h)))))
        if _rare_count(text) >= licences.RARE_LEAST:
            for part in {"\n".join(passages)} | ({text} if named else set()):
                for b in _full_names(part, least):
                    hits.setdefault((i, ""), []).append((False, b, named))
        for said in re.findall(licences.SPDX, text, re.ASCII):
            hits.setdefault((i, ""), []).append((False, (-1, -1.0, re.sub(r"\s+", " ", said)), named))
    n, df = sum(c for _, _, c, _ in found), Counter()
    for _, _, counted, w in found:
        df.update(set(w) if counted else ())
    vec = lambda w: {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(w).items()}
    temp = [(name, t.startswith("SPDX"), vec(_tokens(t))) for name, t in licences.TEMPLATES]
    met = {}
    for i, named, _, w in found:
        if w not in met:
            v, met[w] = vec(w), []
            for name, spdx, t in temp:
                s = _cosine(v, t)
                late = any(x not in v for x in t if spdx or x[0].isdigit())
                if s >= least and not (spdx and late):
                    rank = 2 if name == "All-rights-reserved" else 1
                    met[w].append((re.sub(r"-[0-9.]+$", "", name), late, (rank, -s, name)))
        for family, late, b in met[w]:
            hits.setdefault((i, family), []).append((late, b, named))
    best = {}
    for (i, _), h in hits.items():
        best.setdefault(i, []).append((min(x[:2] for x in h)[1], any(x[2] for x in h)))
    return {i: (min(b for b, _ in x), "file" if any(k for _, k in x) else "header") for i, x in best.items()}


def _folder(path):
    plain = re.sub(r"^\./", "", re.sub(r"/(?:\.?/)+", "/", path))
    return re.sub(r"/*[^/]*$", "", plain)


def _scan(rows, least=0.6):
    """TF-IDF cosine by plain dictionaries, then the nearest ancestor, the top last."""
    own, given, out = _own_licences(rows, least), {}, {}
    for i, path, _ in rows:
        named = bool(re.match(licences.FILE_NAME, (path or "").rsplit("/", 1)[-1]))
        if i in own:
            (_, s, name), kind = own[i]
            out[i] = (name, -s, kind, None)
        else:
            out[i] = (None, None, "file" if named else None, None)
        if out[i][2] == "file" and path is not None:
            mine = (1.0, "") if out[i][0] is None else (-out[i][1], out[i][0])
            given[_folder(path)] = min(given.get(_folder(path), mine), mine)
    for i, path, _ in rows:
        if out[i][2] is None and path is not None:
            d = _folder(path)
            while d not in given and d:
                d = d.rsplit("/", 1)[0] if "/" in d else ""
            if d in given:
                s, name = given[d]
                out[i] = (name, -s, "inherited", d) if name else (None, None, "inherited", d)
    return out


def test_licences_equal_brute_force(spark):
    mit, gpl = "Released under the MIT License.\nSome words follow here.", "GNU General Public License, version 3. licensed work"
    rows = [
        (1, "/a/LICENSE", mit), (2, "/a/b/x.py", "no header"), (3, "/a/b/c/COPYING.txt", gpl), (4, "/a/b/c/y.py", ""),
        (5, "/a/b/c/d/z.py", None), (6, "/q/r.py", "Text. Licensed under CC BY-NC 4.0. More text."), (7, "/q/s.py", "x"),
        (8, "top.py", "x"), (9, None, "This work is licensed under the GNU General Public License, version 3."), (10, None, None),
        (11, "/a/b/license.md", "nothing of the kind"), (12, "/ab/t.py", "x"), (13, "/a/b/w.py", "copyright law was discussed at length by the many people there"),
        (14, "/LICENSE", mit), (15, "/q/u.py", "All rights reserved."),
        (16, "/d/COPYING", (licences.TEXTS / "GPL-2.0.txt").read_text()), (17, "/d//./e.c", "x"), (18, "./f/LICENSE", gpl), (19, "f/g/h.c", None),
        (20, "/d/i.c", "// SPDX-License-Identifier: (GPL-2.0 OR BSD-3-Clause)\n"), (21, "/d/j.c", "SPDX-License-Identifier: Apache-2.0 OR  MIT"),
        (22, "/d/k.c", "/* under the GNU General\n * Public License, version 2 */"), (23, "/f/LICENSE", None), (24, "/f/l.c", "x"),
        (25, "/m/LICENSE", mit), (26, "/m/LICENSE.more", gpl), (27, "/m/n.c", "x"), (28, "/m/COPYING", "unheard of terms"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id long, path string, text string, score int")
    got = {r["id"]: (r["licence"], r["score"], r["kind"], r["origin"]) for r in licences.scan(df).collect()}
    want = _scan(rows)
    assert got == {i: (a, s and pytest.approx(s, abs=1e-8), k, o) for i, (a, s, k, o) in want.items()}
    assert got[4][0] == got[5][0] == "GPL-3.0" and got[12][:1] + got[12][2:] == ("MIT", "inherited", "")
    # a licence file that is not recognised stops the search
    assert got[11] == (None, None, "file", None) and got[2] == got[13] == (None, None, "inherited", "/a/b")
    assert got[17][0] == "GPL-2.0" and got[19][:1] + got[19][2:] == ("GPL-3.0", "inherited", "f")
    assert got[20][0] == "(GPL-2.0 OR BSD-3-Clause)" and got[21][0] == "Apache-2.0 OR MIT" and got[24][3] == "/f"
    assert licences.scan(df.limit(0)).count() == 0
    assert licences.scan(df.unionByName(df)).count() == 2 * len(rows)


def test_licence_query_equals_brute_force(spark):
    got = {r["doc_id"]: (r["licence"], r["kind"], r["origin"]) for r in queries.op6_licence_scan(spark, SF001).collect()}
    files = licences.document_files(spark.read.parquet(f"{SF001}/documents.parquet")).collect()
    want = _scan([(r["id"], r["path"], r["text"]) for r in files])
    assert got == {i: (a, k, o) for i, (a, _, k, o) in want.items()}


# -- extraction ------------------------------------------------------------


def test_pages_equal_their_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = queries.op8_html_blocks(spark, SF001).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inner))
        want = "\n".join(x for x in (" ".join(html_lib.unescape(p).split()) for p in parts) if x)
        assert r["text"] == want and r["n_chars"] == len(want) and r["url"] == pages[r["page_id"]]["url"]


LONG = "This is a paragraph of the article that has many of the words of a text in it and it goes on for a while so that it is long enough to be sure of. "


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("<p>a &lt; b &amp; c&nbsp;d <b>e</b>f</p>", "a < b & c d ef"),
        (f"<div><h2>Title</h2><p>{LONG * 2}</p><p>Short.</p></div>", f"Title\n{(LONG * 2).strip()}\nShort."),
        (f"<nav>Menu</nav><article><p>Is.</p><!-- x --><script>var a='</p>';</script><p>The end.</p></article><p>{LONG}</p>", "Is.\nThe end."),
        (f"<article><header><h1>Head</h1></header><p>x</p><div class='reader-comments'><p>{LONG}</p></div><aside>y</aside><form>z</form></article>", "Head\nx"),
        (f"<header><h1>Site</h1></header><div id=main><p>{LONG}</p></div><div class='ad'>{LONG}</div><div class=cookie-notice>{LONG}</div><footer>f</footer>", LONG.strip()),
        (f"<ul><li><a href=1>one of the links</a></li></ul><p>{LONG}</p><p>{LONG}<a href=2>more</a></p>", f"{LONG.strip()}\n{LONG}more"),
        ("<article><p>one<br>two<br><br>three<p>four<li>five</article>", "one two\nthree\nfour\nfive"),
        ("<article>a<script>never closed", "a"),
        ("<article>a<!-- never closed", "a"),
    ],
)
def test_block_rules(page, want):
    assert htmltext.main_text(page) == want


def test_open_blocks_take_the_nearest_label():
    blocks = [htmltext.Block(text="x", heading=h) for h in (False, False, True, False, False)]
    c, b, o = htmltext.CONTENT, htmltext.BOILERPLATE, htmltext.OPEN
    assert htmltext.second_pass(blocks, [b, o, o, o, c]) == [b, b, c, c, c]
    assert htmltext.second_pass(blocks, [o, o, o, o, o]) == [c] * 5
    assert htmltext.second_pass(blocks, [o, c, o, b, o]) == [c, c, b, b, b]


def test_extraction_of_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>" * 20000 + "x"), (3, "u", "<p>" * 20000 + "x"), (None, "u", "t")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in htmltext.extract(df).collect())
    assert got == [(0, "t", 1), (1, "", 0), (2, "", 0), (3, "x", 1), (3, "x", 1)]
    assert htmltext.extract(df.limit(0)).count() == 0


# -- fingerprints ----------------------------------------------------------


def _counts(text):
    """Bucket counts byte by byte."""
    raw, out = text.encode(), [0] * digest.BUCKETS
    for i in range(len(raw)):
        for k, (p, q) in enumerate(digest._TRIPLETS):
            if i >= q:
                h = (int(digest._A[raw[i]]) + int(digest._B[raw[i - p]]) + int(digest._C[raw[i - q]]) + k * 0x1F123BB5) % 2**32
                h = (h ^ (h >> 15)) * 0x2C1B3C6D % 2**32 >> 25
                out[h] += 1
    return out


def test_counts_equal_byte_by_byte():
    texts = ["", "a", "abc", "abcd", "hello wörld, hello", "x" * 50]
    assert digest.triplet_counts(*as_block(texts)).tolist() == [_counts(t) for t in texts]


def test_quartile_codes():
    counts = np.arange(digest.BUCKETS)[None, :]
    body = digest.codes(counts, np.array([100]))[0, 3:]
    assert Counter(body.tolist()) == dict.fromkeys(range(4), digest.BUCKETS // 4)
    d = digest.digest(["", "abc", "abc", "z" * 300])
    assert digest.likeness(d[1:2], d[2:3])[0] == digest.likeness(d[:1], d[:1])[0] == 1.0
    assert len(set(digest.hexes(d))) == 3


def _edited(rows):
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        f, g, h = digest.digest([t]), digest.digest([e]), digest.digest([nxt])
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), *digest.hexes(f), *digest.hexes(g), digest.likeness(f, g)[0], digest.likeness(f, h)[0]))
    return out


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("n", [1, 2, 7, 200])
def test_edited_likeness_equals_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(3 * i - 50, rng.choice([None, "", "é" * i, "word " * rng.randint(0, 90) + str(i)])) for i in range(n)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string").repartition(3)
    got = sorted(map(tuple, digest.edited_likeness(df).select(COLUMNS).collect()))
    assert got == _edited(rows)


def test_edited_likeness_of_odd_ids(spark):
    rows = [(None, "bbbb bbb"), (1, "a text of words"), (1, "a text of words"), (2, "other 12345678 things")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["near_next"]) for r in digest.edited_likeness(df).collect())
    assert [i for i, _ in got] == [0, 1, 1, 2] and got[1:3].count((1, 1.0)) == 1
    assert digest.edited_likeness(df.limit(0)).count() == 0


def test_half_a_text_is_nearer_than_another(spark):
    r = digest.edited_likeness(spark.read.parquet(f"{SF001}/documents.parquet")).selectExpr("avg(cast(near_edited > near_next as int))").first()
    assert r[0] > 0.95


# -- pipeline --------------------------------------------------------------


def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "quality", "near_duplicates", "mix", "encode"]
    # names that the stages use inside, and a row without an id, one without a text
    clash = ["_letter", "_has_letter", "_lang_score", "_quality_score", "_copy", "_id", "_n", "row", "doc", "component_id", "kept"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet").selectExpr("*", "1.5D AS score", *(f"'{c}' AS {c}" for c in clash))
    rest = docs.columns[docs.columns.index("source") + 1 :]
    extra = docs.filter("doc_id = 13").selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat(text, ' and some more words') AS text", "lang", "source", *rest)
    null = extra.selectExpr("-5L AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "CAST(NULL AS STRING) AS source", *rest)
    docs = docs.unionByName(extra).unionByName(null)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF001).cache()
        if name != "encode":
            assert after.columns == docs.columns
            assert after.filter(" OR ".join(f"{c} <> '{c}'" for c in clash)).count() == 0
        if name == "language":
            gone = docs.join(after.select("doc_id"), docs["doc_id"].eqNullSafe(after["doc_id"]), "left_anti").collect()
            assert any(r["doc_id"] == -5 for r in gone) and len(gone) < 0.05 * docs.count()
            # besides, texts that repeat one word or are very short
            assert all(r["text"] is None or len(set(r["text"].split())) < 0.5 * len(r["text"].split()) or len(r["text"]) < 200 for r in gone)
        if name == "quality":
            kept = {r["doc_id"] for r in after.select("doc_id").collect()}
            bad = [i for i, q in labels.items() if (i in kept) != (q == 1)]
            assert len(bad) <= 0.02 * len(labels)
        if name == "near_duplicates":
            _check_groups(before, after)
        if name == "mix":
            assert set(after.distinct().collect()) <= set(before.collect()) and after.groupBy("doc_id").count().filter("count > 3").count() == 0
        if name == "encode":
            t = Tokenizer.from_file(VOCABULARY)
            text = {r["doc_id"]: r["text"] for r in before.collect()}
            assert after.count() == before.count()
            for r in after.limit(40).collect():
                assert r["ids"] == t.encode(text[r["doc_id"]], add_special_tokens=False).ids
        before = after


def _check_groups(before, after):
    """One document of each group of near copies (five words, 0.8) stays, checked pair by pair."""
    rows = [(r["doc_id"], r["text"]) for r in before.collect() if r["doc_id"] is not None]
    sets, index = {}, {}
    for i, t in rows:
        w = t.encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)])
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    freq = Counter(g for s in sets.values() for g in s)
    for i in sorted(sets, key=lambda i: len(sets[i])):
        x = sets[i]
        near = set()
        for g in sorted(x, key=lambda g: (freq[g], g))[: len(x) - -(-len(x) * 8 // 10) + 1]:
            near.update(index.setdefault(g, []))
            index[g].append(i)
        for j in near:
            if 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    kept = {r["doc_id"] for r in after.collect()} - {None}
    assert kept == {i for i in sets if root(i) == i}


def test_pipeline_keeps_one_of_equal_rows_and_of_copies_without_id(spark):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(None, text), (None, text + " more"), (4, "one two three four five six"), (4, "one two three four five six"), (5, text), (3, text), (None, "alone in the world it is"), (6, ""), (7, None)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kept string")
    got = corpus_pipeline.near_duplicates(spark, df, SF001)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(str(Row(doc_id=i, text=t, kept="k")) for i, t in [(3, text), (4, rows[2][1]), (None, rows[6][1]), (6, ""), (7, None)])


def test_pipeline_run_is_registered(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    out = corpus_pipeline.run(spark, SF0001)
    assert out.count() > 50 and {"doc_id", "n_tokens", "ids"} <= set(out.columns)
