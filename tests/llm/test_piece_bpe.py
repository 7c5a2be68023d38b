"""Encoding through a serialised sentencepiece model against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from ratekit.llm import piece_bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as f:
        return piece_bpe.Coder(f.read(), PATTERN)


def _packed(ids):
    return np.asarray(ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_random_texts_equal_the_library(library, coder, texts):
    assert coder.encode(texts) == [_packed(library.encode_ordinary(t)) for t in texts]


def test_code_points_and_every_whole_piece(library, coder):
    points = [*range(0xD800), *range(0xE000, 0x20000), *range(0x20000, 0x110000, 97)]
    texts = [f"a{c} {c}1" for c in map(chr, points)]
    texts += [p.decode() for p in coder.ranks if "�" not in p.decode("utf-8", "replace")]
    for at in range(0, len(texts), 50_000):
        part = texts[at : at + 50_000]
        assert coder.encode(part) == [_packed(i) for i in library.encode_ordinary_batch(part)]


def test_long_pieces_and_bounded_store(library, coder, monkeypatch):
    monkeypatch.setattr(piece_bpe, "KEEP", 50)
    rng = random.Random(3)
    texts = ["a" * 3000, "ab" * 4000, "é" * 2000, "▁<unk>" * 40, " " * 700, "".join(rng.choices("abcdeé", k=30_000))]
    texts += [" ".join("".join(rng.choices("abcd", k=rng.randint(1, 9))) for _ in range(60)) for _ in range(50)]
    for t in texts + texts:
        (got,) = coder.encode([t])
        assert got == _packed(library.encode_ordinary(t))
        assert coder.decode(got) == t.encode()


def test_model_keeps_ranks_and_rejects_bad_ones():
    single = {bytes([b]): b for b in range(256)}
    coder = piece_bpe.Coder(b"\n".join(base64.b64encode(p) + b" %d" % r for p, r in {**single, b"ab": 300, b"aba": 299}.items()), PATTERN)
    # 256 to 298 are free; "aba" is met only after "ab", although its rank is lower
    texts = ["aba", "abab", "xab ab"]
    own = tiktoken.Encoding("small", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    assert coder.encode(texts) == [_packed(own.encode_ordinary(t)) for t in texts]
    assert np.frombuffer(coder.encode(["abab"])[0], "<u4").tolist() == [299, 98]
    with pytest.raises(ValueError):
        piece_bpe.serialise({b"a": 0})
    with pytest.raises(ValueError):
        piece_bpe.serialise({**single, b"ab": 7})


def _want(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(_packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_piece_bpe(spark, SF001).collect()}
    assert got == {r["doc_id"]: _want(library, r["text"]) for r in docs}


def test_defined_results_and_round_trip(spark, library):
    rows = [(1, None, 5), (2, "", 5), (2, "twice", 6), (2, "twice", 6), (None, "no id", 7), (3, " x\u0000é\r\n", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = piece_bpe.encode_documents(df, PATH, PATTERN, with_ids=True)
    assert sorted(map(str, ((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out.collect()))) == sorted(
        str((i, *_want(library, t))) for i, t, _ in rows
    )
    back = piece_bpe.decode_documents(out, PATH, PATTERN)
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(str((i, t or "")) for i, t, _ in rows)
    empty = df.limit(0)
    assert piece_bpe.encode_documents(empty, PATH, PATTERN, with_ids=True).collect() == []
    assert piece_bpe.decode_documents(spark.createDataFrame([(1, None)], "doc_id string, ids array<int>"), PATH, PATTERN).collect() == [("1", "")]
