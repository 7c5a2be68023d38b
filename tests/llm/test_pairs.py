"""Near-duplicate operators against brute force."""

import numpy as np
import pytest

from ratekit.llm import components as cc
from ratekit.llm import minhash, vectors


def _groups(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def _sets(docs, width):
    out = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        out[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    return out


def _brute(docs, width, percent=80):
    s = _sets(docs, width)
    links = []
    ids = sorted(s)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
                links.append((a, b))
    return s, _groups(ids, links)


@pytest.fixture(scope="module")
def corpus():
    """Chains of edits, a large group of copies at all distances, shared passages, short texts."""
    rng = np.random.default_rng(11)
    word = lambda: f"w{rng.integers(4000)}"
    docs, base = [], [word() for _ in range(90)]
    for i in range(160):
        t = list(base)
        for k in rng.choice(90, int(rng.integers(0, 14)), replace=False):
            t[k] = word()
        docs.append((i, " ".join(t)))
    chain = [word() for _ in range(60)]
    for i in range(160, 190):
        chain[int(rng.integers(60))] = word()
        docs.append((i, "  ".join(chain).upper() if i % 2 else "\n".join(chain)))
    passage = [word() for _ in range(50)]
    docs += [(i, " ".join(passage + [word() for _ in range(int(rng.integers(5, 40)))])) for i in range(190, 240)]
    docs += [(240, "one two"), (241, "ONE\ttwo"), (242, "one two three"), (243, ""), (244, None), (245, " \n"), (246, "one"), (247, "a b c d"), (248, "a b c d e")]
    return docs


def test_minhash_equals_brute_force(spark, corpus):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in corpus], "doc_id long, text string, component_id string, id int")
    for width in (4, 5):
        sets, comp = _brute(corpus, width)
        got = {r["doc_id"]: r for r in minhash.near_duplicates(df, width).collect()}
        assert {i: (len(sets[i]), comp[i], comp[i] == i) for i in comp} == {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()}


def test_minhash_last_round_alone_and_with_pivots(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    _, comp = _brute(corpus, 4)
    for pivots in (0, 3):
        got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, 4, pivots=pivots).collect()}
        assert got == comp


def test_minhash_defined_results(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (3, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in got if r["doc_id"]) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    assert [(r["component_id"], r["kept"], r["n_shingles"]) for r in got if r["doc_id"] is None] == [(None, True, 3)]
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), 4).count() == 0


def test_parity_bound_never_exceeds_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 400)), dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 1 << 63, 30, dtype=np.uint64)]))
        bits = minhash.parities(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        apart = sum(int(x).bit_count() for x in (bits[0] ^ bits[1]).view(np.uint64).tolist())
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(8)
    common = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    own = rng.integers(0, 1 << 63, (2, 100), dtype=np.uint64)
    sets = [np.unique(np.concatenate([common, o])) for o in own]
    bands, _ = minhash.signatures(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]))
    share = (bands[0] == bands[1]).mean()  # (800 / 1000) ** 6 = 0.26
    assert 0.08 < share < 0.5


@pytest.mark.parametrize("task_edges", [1_000_000, 40])
def test_components(spark, task_edges):
    rng = np.random.default_rng(task_edges % 7)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, k) for k in range(2000, 2100)]
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    ids = {x for a, b in links if a != b for x in (a, b)}
    got = {r["id"]: r["component_id"] for r in cc.components(df, task_edges=task_edges).collect()}
    assert got == _groups(ids, [(a, b) for a, b in links if a != b])
    assert cc.components(df.limit(0)).count() == 0


def _vectors(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    centres = rng.normal(size=(4, 16))
    for i in range(700):
        k = i % 7
        v = rng.normal(size=16) if k > 3 else centres[k] + rng.normal(size=16) * (0.05, 0.15, 0.25, 0.3)[k]
        rows.append((i, [float(x) for x in v.astype(np.float32)], 1 if k == 0 else int(rng.integers(0, 3))))
    rows += [(700 + k, rows[5 * k][1], rows[5 * k][2]) for k in range(60)]
    rows += [(800, None, 1), (801, [0.0] * 16, 1), (802, [float("nan")] * 16, 1), (803, [1.0, None] * 8, 1), (804, [], 1), (805, rows[0][1], None), (806, [float("inf")] + [1.0] * 15, 1), (807, [1.0, 2.0], 1), (808, [2.0, 4.0], 1)]
    return rows


def test_vectors_equal_brute_force(spark):
    rows = _vectors()
    ok = [(i, np.array(v, float), lab) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, n = [], {i: 0 for i, *_ in rows}
    for k, (i, v, lab) in enumerate(ok):
        for j, w, lab2 in ok[k + 1 :]:
            if lab == lab2 and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93:
                links.append((i, j))
                n[i] += 1
                n[j] += 1
    comp = _groups(n, links)
    assert len(links) > 2000
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, links string")
    for conf in ({}, {"block": 20, "sample": 200, "least": 3}, {"pivots": 0}):
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(df, **conf).collect()}
        assert got == {i: (n[i], comp[i], comp[i] == i) for i in n}, conf


def test_vectors_defined_results(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [1.0, 0.0], 2)]
    got = vectors.near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"]) == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is None] == [(0, None, True)]


def test_pivot_cells_hold_dense_groups(spark):
    rows = [r for r in _vectors() if r[0] < 700]
    pivots = vectors.choose_pivots([{"label": lab, "dim": 16, "embedding": v} for _, v, lab in rows], float(np.arccos(0.93)), 50, 6)
    assert pivots[(1, 16)].shape[0] >= 1 and np.allclose(np.linalg.norm(pivots[(1, 16)], axis=1), 1)


def test_minhash_hot_copies_empty_texts_and_documents_with_two_texts(spark, corpus):
    """A third of the rows equal, a third empty, ids with several texts."""
    base = [t for _, t in corpus[:40]]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(1000 + i, base[3]) for i in range(900)] + [(3000 + i, "" if i % 2 else None) for i in range(900)]
    far = " ".join(f"z{k}" for k in range(40))
    rows += [(5000, "only here " * 3), (5000, far), (5001, far + " more"), (5002, "not alike at all, this one"), (5000, far), (None, far), (None, base[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    # brute force over rows; rows of one document are linked
    sets = [_sets([(0, t)], 4)[0] for _, t in rows]
    some = {}
    for k, s in enumerate(sets):
        if s and rows[k][0] is not None:
            some.setdefault(frozenset(s), k)
    kinds = list(some.items())
    links = [(k, some[frozenset(s)]) for k, s in enumerate(sets) if s and rows[k][0] is not None]
    links += [(i, j) for x, (a, i) in enumerate(kinds) for b, j in kinds[x + 1 :] if 100 * len(a & b) >= 80 * len(a | b)]
    by_id = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            links.append((k, by_id.setdefault(i, k)))
    groups = _groups(range(len(rows)), links)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[groups[k]] = min(least.get(groups[k], i), i)
    want = sorted(str((i, len(sets[k]), None if i is None else least[groups[k]])) for k, (i, _) in enumerate(rows))
    got = minhash.near_duplicates(df, 4).collect()
    assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == want
    assert {r["component_id"] for r in got if r["doc_id"] in (5000, 5001)} == {5000}


def test_minhash_small_sets_are_found_exactly(spark):
    rng = np.random.default_rng(4)
    docs = []
    for i in range(600):
        words = [f"v{rng.integers(8)}" for _ in range(int(rng.integers(4, 16)))]
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    _, comp = _brute(docs, 4)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, 4).collect()} == comp
    for _ in range(3000):  # similar small sets share a prefix shingle
        a = np.unique(rng.integers(0, 1 << 62, 15).astype(np.uint64)[: rng.integers(4, 16)])
        b = np.unique(np.append(rng.permutation(a)[: max(1, int(0.9 * len(a)))], rng.integers(0, 1 << 62, 1).astype(np.uint64)))
        if len(b) < 16 and 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)):
            x, y = (minhash.prefixes(s, np.array([0, len(s)]), 80)[0] for s in (a, b))
            assert np.intersect1d(x, y).size


def test_vectors_with_hot_copies_and_many_invalid_ones(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(30, 8))
    rows = [(i, base[i].tolist(), 1) for i in range(30)]
    rows += [(100 + i, (base[2] * (1 + i % 3)).tolist(), 1) for i in range(700)]
    rows += [(1000 + i, [0.0] * 8 if i % 2 else None, 1) for i in range(700)]
    rows += [(2000, (base[2] + 0.01).tolist(), 1), (2001, base[2].tolist(), 2), (2002, base[2].tolist(), None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(df).collect()}
    valid = [(i, np.array(e), y) for i, e, y in rows if e and any(e) and y is not None]
    unit = np.array([e / np.linalg.norm(e) for _, e, _ in valid])
    near = (unit @ unit.T >= 0.93) & (np.array([[a[2] == b[2] for b in valid] for a in valid]))
    links = [(valid[x][0], valid[y][0]) for x, y in zip(*np.nonzero(near)) if x < y]
    comp = _groups([r[0] for r in rows], links)
    count = {v[0]: int(n) - 1 for v, n in zip(valid, near.sum(axis=1))}
    assert got == {i: (count.get(i, 0), comp[i], comp[i] == i) for i, _, _ in rows}
