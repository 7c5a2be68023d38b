"""Language, quality and toxicity: held-out accuracy and defined results."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratekit.llm import langid, quality, queries, toxicity
from ratekit.llm.common import as_block, blocks, words_of

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, extra string, score double"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and very long texts, repeated rows, clashing columns."""
    rows = [
        (1, None, None, None, "x", 9.0),
        (2, "", "en", None, "x", 9.0),
        (3, " \n\t", "en", "s", "x", 9.0),
        (4, "12 345 !?", "en", "s", "x", 9.0),
        (5, "the and of with by in on at the", "en", "s", "x", 9.0),
        (5, "the and of with by in on at the", "en", "s", "x", 9.0),
        (None, "the and", None, "s", None, None),
        (6, "the and idiot of " * 20000, None, "s", "x", 9.0),
    ]
    return spark.createDataFrame(rows, DOCS)


def test_words_match_split():
    texts = ["Ab  cd\x0bE", "", " x ", "é日 b\x85c"]
    w = words_of(*as_block(texts), kinds=("word", "pre2", "suf2"))
    assert np.diff(w.first).tolist() == [len(t.encode().split()) for t in texts]
    lower = words_of(*as_block(["ab cd e"]), kinds=("word",)).hashes["word"]
    assert (w.hashes["word"][:3] == lower).all()


def test_language_is_right_on_unseen_rows(spark, documents):
    got = queries.op9_language_centroids(spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    j = got.join(documents.select("doc_id", "lang"), "doc_id").filter("held_out")
    n, right, kept = j.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum((~F.col("rejected")).cast("int"))).first()
    # rejected are texts of one word over and over, the made junk of the tables
    assert n > 150 and right / n > 0.97 and kept / n > 0.95
    odd = got.filter("rejected").join(documents.select("doc_id", "text"), "doc_id").collect()
    assert all(len(set(r["text"].split())) < 0.5 * len(r["text"].split()) or len(r["text"]) < 200 for r in odd)
    assert got.filter("score < 0 OR score > 1").count() == 0


@pytest.mark.parametrize("lang", ["de", "es", "fr"])
def test_a_language_that_was_not_learned_is_rejected(spark, documents, lang):
    model = langid.fit(documents.filter(F.col("lang") != lang))
    of = documents.filter((F.col("lang") == lang) & (F.length("text") > 400))
    n, out = langid.classify(of, model).agg(F.count("*"), F.sum(F.col("rejected").cast("int"))).first()
    assert n > 50 and out / n > 0.5


def test_radius_is_smooth_in_the_length_and_not_widened_by_odd_texts(documents):
    model = langid.fit(documents)
    assert (np.diff(model.nearest, axis=1) >= 0).all() and (model.nearest[:, 0] == 0).all()
    wrong = documents.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 250 == 1, "de").otherwise(F.col("lang")))
    other = langid.fit(wrong)
    at = lambda m: m.nearest[m.langs.index("de")][13]
    assert at(other) > 0.5 * at(model)


def test_many_language_values_are_bounded(spark, documents):
    junk = documents.withColumn("lang", F.when(F.col("lang") == "en", F.concat(F.lit("x"), F.col("doc_id"))).otherwise(F.col("lang")))
    model = langid.fit(junk, max_langs=3)
    assert set(model.langs) == {"de", "es", "fr"}


def test_language_defined_results(spark, documents, odd):
    model = langid.fit(documents)
    got = [(r["doc_id"], r["lang_pred"], r["rejected"]) for r in langid.classify(odd, model).collect()]
    by = {k: v for k, *v in got}
    assert len(got) == 8 and all(by[k] == ["und", True] for k in (1, 2, 3, 4))
    assert by[5] == ["en", False] and by[6][0] == "en"
    far = spark.createDataFrame([(1, "zzqx " * 400)], "doc_id long, text string")
    assert langid.classify(far, model).first()["rejected"]
    out = langid.annotate(odd, model, prefix="_p_")
    assert out.columns[:6] == odd.columns and out.filter("score = 9.0").count() == 7
    empty = documents.limit(0)
    assert langid.fit(empty) is None
    assert langid.classify(odd, None).filter("lang_pred <> 'und' OR NOT rejected").count() == 0
    assert langid.classify(empty, model).count() == 0


def test_quality_is_right_on_unseen_rows(spark, labels):
    got = queries.op5_quality_attention(spark, SF)
    j = got.filter("held_out").join(labels, "doc_id")
    n, right = j.agg(F.count("*"), F.sum((F.col("quality") == F.col("predicted")).cast("int"))).first()
    assert n > 50 and right / n > 0.95
    assert got.filter("score < 0 OR score > 1 OR (score >= 0.3) <> (predicted = 1)").count() == 0


def test_quality_defined_results(documents, labels, odd):
    model = quality.fit(documents, labels, epochs=2)
    rows = quality.score(odd, model).collect()
    s = {r["doc_id"]: r["score"] for r in rows}
    assert len(rows) == 8 and s[1] == s[2] == s[3]
    assert len({r["score"] for r in rows if r["doc_id"] == 5}) == 1
    assert quality.fit(documents, labels.limit(0)) is None
    assert quality.fit(documents, labels.filter("quality = 1")) is None
    assert {r["score"] for r in quality.score(odd, None).collect()} == {0.5}
    assert quality.score(odd.limit(0), model).count() == 0


def test_attention_weights_sum_to_one_and_match_one_bag_at_a_time(documents, labels):
    model = quality.fit(documents, labels, epochs=1)
    texts = ["a b c " * 100, "", "Z!! Y!! " * 90]
    x, first = quality.passages(*as_block(texts))
    *_, a, bag, _, p = quality._forward(model, x, first)
    assert np.allclose(np.bincount(bag, a), 1)
    alone = [quality._forward(model, *quality.passages(*as_block([t])))[-1][0] for t in texts]
    assert np.allclose(p, alone)


def _brute(emit, head, trans, start):
    """Marginals by summing over all label sequences of each chain."""
    out, at = [], 0
    cuts = [*np.flatnonzero(head), len(emit)]
    for lo, hi in zip(cuts, cuts[1:]):
        n = hi - lo
        total, one = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            s = start[y[0]] + sum(trans[a, b] for a, b in zip(y, y[1:])) + sum(e for e, v in zip(emit[lo:hi], y) if v)
            total += np.exp(s)
            one += np.exp(s) * np.array(y)
        out.append(one / total)
        at = hi
    return np.concatenate(out)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    for lengths in ([1], [3, 1, 8], [5, 9, 2]):
        n = sum(lengths)
        head = np.zeros(n, bool)
        head[np.cumsum([0, *lengths[:-1]])] = True
        emit, trans, start = rng.normal(0, 3, n), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)
        assert np.allclose(toxicity.marginals(emit, head, trans, start), _brute(emit, head, trans, start))


def test_forward_backward_rows_do_not_matter(monkeypatch):
    rng = np.random.default_rng(4)
    emit, trans, start = rng.normal(-2, 6, 1000), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)
    head = rng.random(1000) < 0.01
    head[0] = True
    want = toxicity.marginals(emit, head, trans, start)
    monkeypatch.setattr(toxicity, "ROW", 7)
    assert np.allclose(toxicity.marginals(emit, head, trans, start), want)


def test_toxicity_on_planted_texts(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(200)]
    rows, labs = [], []
    for i in range(400):
        t = list(rng.choice(words, 40))
        if i % 2:
            t[int(rng.integers(40))] = ("vilest", "Grubby")[i % 4 // 2]
        rows.append((i, " ".join(t), "x"))
        labs.append((i, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    lab = spark.createDataFrame(labs, "doc_id long, toxic int")
    model = toxicity.fit(docs, lab)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i]["predicted"] == i % 2 for i in got)
    text = dict((i, t) for i, t, _ in rows)
    for i in range(1, 400, 2):
        assert [text[i][s["begin"] : s["end"]].lower() for s in got[i]["spans"]] in (["vilest"], ["grubby"])


def test_toxicity_defined_results(documents, labels, odd):
    model = toxicity.fit(documents, labels)
    rows = toxicity.score(odd, model).collect()
    s = {r["doc_id"]: r for r in rows}
    assert len(rows) == 8 and s[1]["score"] == s[2]["score"] == s[3]["score"] < 0.7
    assert s[1]["spans"] == [] and s[6]["predicted"] == 1 and len(s[6]["spans"]) == 20000
    assert toxicity.fit(documents, labels.limit(0)) is None
    none = toxicity.score(odd, None).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 0)}


def test_toxicity_is_right_on_unseen_rows(spark, labels):
    got = queries.op2_toxicity_crf(spark, SF)
    j = got.filter("held_out").join(labels, "doc_id")
    n, right = j.agg(F.count("*"), F.sum((F.col("toxic") == F.col("predicted")).cast("int"))).first()
    assert n > 80 and right / n > 0.95
    assert got.filter("(score >= 0.7) <> (predicted = 1) OR score < 0 OR score > 1").count() == 0


def test_blocks_keep_every_row_in_order():
    texts = ["x" * n for n in (0, 5, 900, 3, 0, 2500, 1, 1, 1)] * 7
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    for size, rows in ((1000, 100), (10**6, 4), (1, 1)):
        parts = list(blocks(iter([batch, batch.slice(0, 0)]), "text", size, rows))
        assert [i for p in parts for i in p.column("id").to_pylist()] == list(range(len(texts)))
        assert all(p.num_rows <= rows and (p.num_rows == 1 or sum(map(len, p.column("text").to_pylist())) <= size) for p in parts)
