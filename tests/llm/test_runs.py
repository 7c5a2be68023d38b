"""Periodic runs against a comparison of every pair of shifted positions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF0001
from ratekit.llm import queries, runs


def _brute(words):
    """(start, end, period): for every period the stretches of equal words that far apart."""
    words, out = np.asarray(words), {}
    for q in range(1, len(words) // 2 + 1):
        same = np.r_[False, words[:-q] == words[q:], False].astype(int)
        for s, e in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)):
            if e + q - s >= max(12, 2 * q):
                out.setdefault((int(s), int(e + q)), q)
    return sorted((s, q, e) for (s, e), q in out.items())


def _found(words):
    s, e, q = runs.find_runs(np.asarray(words))
    return list(zip(s.tolist(), q.tolist(), e.tolist()))


def _fibonacci(rng, n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    for _ in range(rng.randint(0, 3)):
        b[rng.randrange(len(b))] = rng.randrange(3)
    return b


def _nested(rng, n):
    x = [rng.randrange(2) for _ in range(rng.randint(1, 4))]
    while len(x) < n:
        y = x * rng.randint(1, 7) + [rng.randrange(3) for _ in range(rng.randint(0, 2))]
        x = y[rng.randint(0, 3) :] if len(y) > 8 else y
    return x[: 2 * n]


def _motifs(rng, n):
    motifs = [[rng.randrange(3) for _ in range(rng.randint(1, 40))] * rng.randint(1, 12) for _ in range(3)]
    x = []
    while len(x) < n:
        x += rng.choice(motifs)
    return x


def _powers(rng, n):
    """Stretches of one word or one pair cut by a rare word: regions that touch."""
    root, x = rng.choice([[0], [0, 1], [0, 0, 1]]), []
    while len(x) < n:
        x += (root * n)[: rng.randint(1, n // 2)] + [7] * rng.randint(0, 1)
    return x * rng.randint(1, 3)


@pytest.mark.parametrize("make", [_fibonacci, _nested, _motifs, _powers])
def test_structured_words_equal_brute_force(make):
    rng = random.Random(make.__name__)
    for _ in range(60):
        words = make(rng, rng.choice([30, 150, 500, 900]))[:2500]
        assert _found(words) == _brute(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=1, max_size=400))
def test_random_words_equal_brute_force(words):
    assert _found(words) == _brute(words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=70), st.integers(2, 6), st.integers(0, 40))
def test_long_periods_equal_brute_force(period, times, tail):
    words = (period * (times + 1))[: len(period) * times + min(tail, len(period))] + [9, 8, 9]
    assert _found(words) == _brute(words)


def test_documents_of_a_block_do_not_meet():
    docs = [b"a b " * 20, b"a b " * 20, b"", b"b a " * 7]
    ids, first, _ = runs._number(docs, [None] * 4)
    s, e, q = runs.find_runs(ids)
    assert list(zip(s.tolist(), e.tolist(), q.tolist())) == [(0, 40, 2), (40, 80, 2), (80, 94, 2)]


def _want(doc_id, text, planted):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if planted and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    found = _brute([number[w] for w in words])
    dropped = {i for s, q, e in found for i in range(s + q, e)}
    best = min(((s - e, s, q) for s, q, e in found), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, q, e in found)
    top = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *top, sha(lines), sha(kept)), found, kept


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op12_word_runs(spark, SF0001).collect()}
    want = {r["doc_id"]: _want(r["doc_id"], r["text"], True)[0] for r in docs}
    assert got == want
    assert sum(w[1] > 0 for w in want.values()) > 10


def test_defined_results(spark):
    line = "the same line of words " * 9
    rows = [
        (1, None, 0), (2, "", 0), (3, " \n", 0), (4, "x " * 11, 0), (5, "x " * 12, 0), (6, line + "end", 0), (6, line + "end", 0),
        (None, "start " + line, 0), (7, "A a " * 10 + "a a " * 13, 0), (8, "é\t" * 40, 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, period int")
    for planted in (False, True):
        out = runs.document_runs(df, planted=planted, details=True).collect()
        want = [_want(i, t, planted) for i, t, _ in rows]
        assert sorted(str(tuple(r)[:8]) for r in out) == sorted(str(w[0]) for w in want)
        spans = [([(x["start"], x["period"], x["start"] + x["length"]) for x in r["runs"]], r["collapsed"]) for r in out]
        assert sorted(map(str, spans)) == sorted(str((w[1], w[2])) for w in want)
    assert runs.document_runs(df.limit(0)).collect() == []


def test_very_long_text(spark):
    rng = random.Random(8)
    period = [f"w{rng.randrange(50)}" for _ in range(30_000)]
    text = " ".join(period * 2 + period[:100] + ["end"] + ["again"] * 50_000)
    (r,) = runs.document_runs(spark.createDataFrame([("t", text)], "doc_id string, text string")).collect()
    assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (0, 60_100, 30_000, 2003)
