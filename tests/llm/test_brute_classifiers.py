"""The classifiers' queries against plain versions that go text by text, word by word."""

import math
import re

import numpy as np
import pytest

from conftest import SF0001
from ratekit.llm import langid, quality, toxicity
from ratekit.llm.common import NON_WORD, as_block, words_of


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    odd = [(-1, None), (-2, ""), (-3, " \n"), (-4, "x"), (-5, "1234 !!"), (-6, "Ünï " * 90)]
    return spark.createDataFrame(rows + odd, "doc_id long, text string").cache()


def _labels(spark):
    return spark.read.parquet(f"{SF0001}/labels.parquet")


def _sigmoid(z):
    return 1 / (1 + math.exp(-z))


# -- quality: passages, attention, score ----------------------------------------


def _passage(words):
    """Shape statistics of one passage (a list of words in bytes)."""
    if not words:
        return [0.0] * quality.N_FEATURES
    low = [w.lower() for w in words]
    symbol = lambda w: sum(33 <= b < 127 and not chr(b).isalnum() for b in w)
    upper = lambda w: sum(65 <= b <= 90 for b in w)
    rows = []
    for i, w in enumerate(words):
        n = len(w)
        again = [float(i >= k and low[i] == low[i - k]) for k in (1, 2, 3)]
        rows.append([
            n, min(n, 40) ** 2 / 40, symbol(w) / n, upper(w) / n, sum(48 <= b <= 57 for b in w) / n, sum(b >= 128 for b in w) / n,
            symbol(w) >= n, symbol(w) >= 2, upper(w) >= n - symbol(w), *again, n <= 3,
        ])
    out = [math.log1p(len(words)), *(sum(c) / len(words) for c in zip(*rows))]
    for end in (-1, 0):
        bucket = [0.0] * 16
        for w in words:
            bucket[(w[end] * 0x9E37 >> 4) % 16] += 1 / len(words)
        out += bucket
    return out


def _quality(m, text):
    words = (text or "").encode().split()
    cut = [words[k : k + 64] for k in range(0, len(words), 64)] or [[]]
    hs, es = [], []
    for passage in cut:
        z = (np.array(_passage(passage)) - m.mean) / m.std
        h = np.tanh(m.w.T @ z + m.b)
        hs.append(h)
        es.append(sum(u * math.tanh(a) * _sigmoid(b) for u, a, b in zip(m.u, m.v.T @ h, m.g.T @ h)))
    weight = np.exp(np.array(es) - max(es))
    pooled = sum(w * h for w, h in zip(weight / weight.sum(), hs))
    return _sigmoid(float(pooled @ m.out) + m.bias)


def test_quality_scores_equal_the_written_out_network(spark, documents):
    m = quality.fit(documents, _labels(spark))
    got = {r["doc_id"]: r for r in quality.score(documents, m).collect()}
    for r in documents.collect():
        want = _quality(m, r["text"])
        assert got[r["doc_id"]]["score"] == pytest.approx(want, abs=1e-4)
        assert abs(want - 0.3) < 1e-4 or got[r["doc_id"]]["predicted"] == (want >= 0.3)


# -- language: n-grams, cosine, radius ------------------------------------------


def _gram_counts(text):
    data = bytes(b if (65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32 for b in (text or "").encode())
    data = re.sub(rb" +", b" ", data).lower()
    out = np.zeros(langid.BUCKETS)
    for k in (2, 3, 4):
        for at in range(len(data) - k + 1):
            code = data[at]
            for j in range(1, k):
                code = (code * 257 + data[at + j] + j + 1) % 2**32
            out[((code * int(langid._MULT[k - 2])) % 2**32) >> 20] += 1
    return out


def _language(m, text):
    c = _gram_counts(text)
    if not re.search(r"[^\W\d_]", text or ""):
        return "und", 0.0, True
    v = np.log1p(c) * m.idf
    v = v / max(np.linalg.norm(v), 1e-30)
    cos = m.centroids @ v
    best = int(cos.argmax())
    score = min(max(float(cos[best]), 0.0), 1.0)
    at = min(math.log2(max(c.sum(), 1)), langid.DOUBLINGS - 1)
    floor = float(np.interp(at, np.arange(langid.DOUBLINGS), m.nearest[best]))
    return m.langs[best], score, score <= 0 or score < floor


def test_languages_equal_the_written_out_cosines(spark, documents):
    learned = spark.read.parquet(f"{SF0001}/documents.parquet")
    m = langid.fit(learned)
    train = [r["text"] for r in learned.filter("lang IS NOT NULL AND text RLIKE '\\\\p{L}' AND crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2").collect()]
    held = sum((_gram_counts(t) > 0).astype(int) for t in train)
    assert np.allclose(m.idf, np.log((1 + len(train)) / (1 + held)) + 1, atol=1e-5)
    got = {r["doc_id"]: r for r in langid.classify(documents, m).collect()}
    for r in documents.collect():
        lang, score, rejected = _language(m, r["text"])
        g = got[r["doc_id"]]
        assert g["score"] == pytest.approx(score, abs=1e-5) and g["lang_pred"] == lang and g["rejected"] == rejected


# -- toxicity: chain, marginals, score --------------------------------------------


def _chain(m, tokens):
    """P(toxic) of every token by the sums over paths, in logarithms, one token after another."""
    if not tokens:
        return []
    hashes = words_of(*as_block([t.decode() for t in tokens]), NON_WORD, toxicity.KINDS).hashes
    emit = [m.bias + sum(m.weights[k, int(hashes[name][i]) >> (64 - toxicity.BITS)] for k, name in enumerate(toxicity.KINDS)) for i in range(len(tokens))]
    add = lambda x, y: max(x, y) + math.log1p(math.exp(-abs(x - y)))
    a = [[m.start[0], m.start[1] + emit[0]]]
    for e in emit[1:]:
        a.append([add(a[-1][0] + m.trans[0][s], a[-1][1] + m.trans[1][s]) + s * e for s in (0, 1)])
    b = [[0.0, 0.0]]
    for e in reversed(emit[1:]):
        b.append([add(m.trans[s][0] + b[-1][0], m.trans[s][1] + e + b[-1][1]) for s in (0, 1)])
    b.reverse()
    return [_sigmoid((x[1] + y[1]) - (x[0] + y[0])) for x, y in zip(a, b)]


def _toxic(m, text):
    data = (text or "").encode()
    found = list(re.finditer(rb"[0-9A-Za-z\x80-\xff]+", data))
    p = _chain(m, [f[0] for f in found])
    high, total = max(p, default=0.0), sum(x for x in p if x >= 0.05)
    q = min(max(high, 1e-4), 1 - 1e-4) if p else 1e-4
    score = _sigmoid(m.calib[0] + m.calib[1] * math.log(q / (1 - q)) + m.calib[2] * math.log1p(total))
    spans, before = [], False
    for f, x in zip(found, p):
        begin, end = (len(data[:k].decode()) for k in f.span())
        if x >= 0.5:
            spans = [*spans[:-1], (spans[-1][0], end)] if before else [*spans, (begin, end)]
        before = x >= 0.5
    return score, spans


def test_toxicity_equals_the_written_out_chain(spark, documents):
    m = toxicity.fit(documents, _labels(spark))
    got = {r["doc_id"]: r for r in toxicity.score(documents, m).collect()}
    hits = 0
    for r in documents.collect():
        score, spans = _toxic(m, r["text"])
        g = got[r["doc_id"]]
        assert g["score"] == pytest.approx(score, abs=1e-6)
        assert [(s["begin"], s["end"]) for s in g["spans"]] == spans
        hits += bool(spans)
    assert hits > 0


def test_fitted_copies_go_and_texts_that_share_a_pair_stay():
    base = " ".join(f"w{k}" for k in range(60))
    texts = [base, base + " end", "w0 w1 only", *(f"of the {k} x{k} y{k}" for k in range(30)), "of the", "one", ""]
    w = toxicity._gathered(texts)
    keep = toxicity._distinct(w, len(texts), 0.8)
    assert keep.tolist() == [True, False, *[True] * (len(texts) - 2)]
