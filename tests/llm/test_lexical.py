"""Ranked search against scores of every document, written out from the definition."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from conftest import SF0001
from ratekit.llm import lexical, queries


def _brute(docs, items, k):
    terms = lambda t: re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda x: x[0].lower(), t or ""))
    rows = [(i, Counter(terms(t))) for i, t in docs]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    total, df = sum(n for _, _, n in rows), Counter(w for _, c, _ in rows for w in c)
    out = []
    asked = {}
    for item, t in items:
        asked.setdefault(item, set()).update(terms(t))
    for item, words in asked.items():
        found = []
        for i, c, n in rows:
            m = 50 + (50 * n * len(rows)) // total
            s = 0
            for x in words:
                if x in c:
                    s += math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * df[x] + 1))) * ((10**9 * c[x]) // (1000 * c[x] + 20 * m))
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def _corpus(seed, n=400):
    rng = np.random.default_rng(seed)
    words = [f"w{x}" for x in range(300)]
    p = 1 / np.arange(1, 301)
    p /= p.sum()
    text = lambda size: " ".join(rng.choice(words, size, p=p))
    docs = [(int(i), text(int(rng.integers(1, 80)))) for i in rng.permutation(n)]
    docs += [(n + i, docs[7][1]) for i in range(60)]  # copies: ties
    items = [(i, text(int(rng.integers(1, 25)))) for i in range(20)]
    return docs, items


@pytest.mark.parametrize("postings", [200, 3000, 1_000_000])
def test_search_equals_all_scores(spark, postings):
    docs, items = _corpus(postings)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(d, i, k=7, block_postings=postings).collect()
    assert sorted(map(tuple, got), key=str) == _brute(docs, items, 7)
    some = lexical.search(d, i, k=7, block_postings=postings, max_item_bytes=300).collect()
    assert sorted(map(tuple, some), key=str) == _brute(docs, items, 7)


def _block(seed):
    rng = np.random.default_rng(seed)
    held = rng.random((60, 12)) < rng.random(12)
    row, term = np.nonzero(held)
    impact = rng.integers(1, 100, len(row))
    block = lexical.Block.of(60, row, term, impact, 12)
    full = np.zeros((60, 12), np.int64)
    full[row, term] = impact
    return block, full, rng


def test_block_search_and_bounds():
    tighter = 0
    for seed in range(150):
        block, full, rng = _block(seed)
        terms = rng.permutation(12)[: rng.integers(1, 12)]
        pairs = [(int(a), int(b)) for a, b in zip(terms[:-1], terms[1:])]
        block.intersect(pairs, 5)
        for a, b in pairs:
            both = np.sort((full[:, a] + full[:, b])[(full[:, a] > 0) & (full[:, b] > 0)])[::-1]
            assert block.joint[a, b] == (both[0] if len(both) else 0, both[4] if len(both) > 4 else 0)
        bound, single = block.prefix_bounds(terms), np.r_[0, np.cumsum(full[:, terms].max(axis=0))]
        reached = np.r_[0, np.cumsum(full[:, terms], axis=1).max(axis=0)]
        assert (reached <= bound).all() and (bound <= single).all() and (np.diff(bound) >= 0).all()
        tighter += (bound < single).any()
        score = full[:, terms].sum(axis=1)
        for floor in (1, int(np.median(score)) + 1, int(score.max()), int(bound[-1]) + 1):
            rows, got = block.search(terms, floor, np.zeros(60, np.int64))
            assert rows.tolist() == np.flatnonzero(score >= floor).tolist() and got.tolist() == score[rows].tolist()
    assert tighter > 100


def test_lists_below_the_floor_are_not_read():
    block, full, _ = _block(3)
    terms = np.argsort(full.max(axis=0))
    block.intersect([(int(a), int(b)) for a, b in zip(terms[:-1], terms[1:])], 5)
    read = []
    plain = block.postings
    block.postings = lambda t: read.append(int(t)) or plain(t)
    block.search(terms, int(block.prefix_bounds(terms)[-1]) + 1, np.zeros(60, np.int64))
    assert not read


def test_defined_results(spark):
    docs = [(1, None), (2, ""), (3, " .,!"), (4, "Apple pear"), (4, "Apple pear"), (None, "apple PEAR"), (5, "Äpfel 7 äpfel É"), (6, "x " * 60_000 + "kiwi"), (7, "other")]
    items = [(1, "apple!"), (1, "pear pear"), (2, None), (3, ""), (None, "kiwi x"), (4, "äpfel É"), (5, "nowhere")]
    d = spark.createDataFrame([(*x, 0, 0) for x in docs], "doc_id long, text string, score int, n int")
    i = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, doc_id int")
    got = lexical.search(d, i, k=3)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == _brute(docs, items, 3)
    assert lexical.search(d.limit(0), i).collect() == [] and lexical.search(d, i.limit(0)).collect() == []
    text = spark.createDataFrame([("b", "pear"), ("a", "pear"), ("c", "fig")], "doc_id string, text string")
    assert [r["doc_id"] for r in lexical.search(text, i.filter("item_id = 1")).orderBy("rank").collect()] == ["a", "b"]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    got = sorted(map(tuple, queries.op11_pair_maxscore(spark, SF0001).collect()))
    assert got == sorted(con.execute(queries.oracle_sql()["op11_pair_maxscore"]).fetchall())
