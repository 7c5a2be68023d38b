"""Byte-level BPE by a sentencepiece model that is written from a rank file, and decoding.

A rank file names byte strings by number. Every byte string becomes a piece of a
sentencepiece BPE model: its bytes mapped to letters one by one, its id the rank, its
score the negative rank, and no normalisation. That model merges the adjacent pair of
highest score, leftmost first, which is the pair of lowest rank: the merge order of the
rank file. The model is serialised directly; nothing is trained.

Text is cut into pre-tokens by the pattern and each is encoded alone. A pre-token that
is in the vocabulary as a whole has that one id, whether or not merges reach it. The
model's ids of pre-tokens met before are kept; the others of a block go through the
model in one call. Decoding maps every id back to its bytes.

Defined results: null is the empty text: no tokens, and the hashes of empty input.
Every character is covered (all 256 bytes are pieces), so nothing is unknown. Very
long pre-tokens take n log n time. Extra columns are ignored; repeated rows and null
ids come out as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import types
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as proto

from .common import BLOCK_BYTES, arrow_map, blocks

#: Bounds of a worker's kept pre-tokens (of each of two generations) and of their length.
KEEP, KEEP_LENGTH = 200_000, 48
#: One letter a byte, all outside white space and the model's own signs.
FIRST_LETTER = 0x4E00
LETTERS = {b: chr(FIRST_LETTER + b) for b in range(256)}
# A piece that no text can contain: the model must name one for the unknown.
UNKNOWN = "▁"


def read_ranks(text: bytes) -> dict[bytes, int]:
    """Byte strings and ranks of a rank file: base64, a space, the rank, one a line."""
    return {base64.b64decode(a): int(r) for a, r in map(bytes.split, text.splitlines()) if a}


def letters(data: bytes) -> str:
    return data.decode("latin-1").translate(LETTERS)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece BPE model of a vocabulary; ids equal ranks, the unknown takes the next free one.

    Ids that the ranks leave out are filled with unused pieces that no text contains.
    """
    for b in range(256):
        if bytes([b]) not in ranks:
            raise ValueError(f"byte {b} has no rank")
    by_rank = {r: p for p, r in ranks.items()}
    if len(by_rank) != len(ranks):
        raise ValueError("two byte strings share a rank")
    model = proto.ModelProto()
    kind = proto.ModelProto.SentencePiece
    for r in range(max(by_rank) + 1):
        if r in by_rank:
            model.pieces.add(piece=letters(by_rank[r]), score=-float(r), type=kind.NORMAL)
        else:
            model.pieces.add(piece=f"{UNKNOWN}{r}", score=0.0, type=kind.UNUSED)
    model.pieces.add(piece=UNKNOWN, score=0.0, type=kind.UNKNOWN)
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(model.pieces) - 1
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Coder:
    """Encoder and decoder of one rank file; ids are packed as little-endian 32-bit integers."""

    def __init__(self, rank_file: bytes, pattern: str):
        ranks = read_ranks(rank_file)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for p, r in ranks.items():
            self.bytes_of[r] = p
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, pieces: set[str], into: dict[str, bytes]) -> None:
        """Packed ids of pre-tokens: whole ones by their rank, the rest by the model in one call."""
        rest, texts = [], []
        for p in pieces:
            raw = p.encode()
            rank = self.ranks.get(raw)
            if rank is None:
                rest.append(p)
                texts.append(raw.decode("latin-1").translate(LETTERS))
            else:
                into[p] = rank.to_bytes(4, "little")
        if rest:
            found = self.model.encode(texts, out_type=int, num_threads=1)
            flat = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
            at = 0
            for p, ids in zip(rest, found):
                to = at + 4 * len(ids)
                into[p] = flat[at:to]
                at = to

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of every text."""
        cut = [self.find(t) for t in texts]
        if len(self.kept) > KEEP:
            self.older, self.kept = self.kept, {}
        kept, older = self.kept, self.older
        new = set(chain.from_iterable(cut)).difference(kept)
        again = new.intersection(older)
        kept.update((p, older[p]) for p in again)
        long_ones = {p for p in new if len(p) > KEEP_LENGTH}
        self._learn(new - again - long_ones, kept)
        if not long_ones:
            return [b"".join(map(kept.__getitem__, c)) for c in cut]
        once: dict[str, bytes] = {}
        self._learn(long_ones, once)
        return [b"".join([once[p] if p in once else kept[p] for p in c]) for c in cut]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def load(rank_file: bytes, pattern: str) -> Coder:
    """The worker's coder of a vocabulary, made once in a Python process."""
    store = sys.modules.setdefault("_ratekit_coders", types.ModuleType("_ratekit_coders")).__dict__
    name = hashlib.sha256(rank_file + pattern.encode()).hexdigest()
    if name not in store:
        store[name] = Coder(rank_file, pattern)
    return store[name]


def _shared(df: DataFrame, vocabulary: str):
    with open(vocabulary, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_documents(documents: DataFrame, vocabulary: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, and ids if asked for.

    ``vocabulary``: path of a rank file on the driver (about a MB, broadcast);
    ``pattern``: what a pre-token is. ids_sha256 is over the ids as little-endian
    unsigned 32-bit integers, decoded_sha256 over the decoded bytes.
    """
    rank_file = _shared(documents, vocabulary)
    src = documents.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches):
        coder = load(rank_file.value, pattern)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for b in blocks(batches, "text", BLOCK_BYTES):
            packed = coder.encode([t or "" for t in b.column("text").to_pylist()])
            n = [len(p) // 4 for p in packed]
            cols = [
                b.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array([sha(p) for p in packed], pa.string()),
                pa.array([sha(coder.decode(p)) for p in packed], pa.string()),
            ]
            if with_ids:
                offs = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                cols.append(pa.ListArray.from_arrays(offs, pa.array(np.frombuffer(b"".join(packed), "<i4"))))
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in fields.split(", ")])

    return arrow_map(src, run, fields)


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str, ids: str = "ids") -> DataFrame:
    """doc_id and the text of its ids (null ids: empty; bytes that are no UTF-8 become U+FFFD)."""
    rank_file = _shared(encoded, vocabulary)
    src = encoded.select("doc_id", ids)
    fields = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text string"

    def run(batches):
        coder = load(rank_file.value, pattern)
        for b in batches:
            packed = (np.asarray(i or (), "<u4").tobytes() for i in b.column(ids).to_pylist())
            texts = pa.array([coder.decode(p).decode("utf-8", "replace") for p in packed], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), texts], names=["doc_id", "text"])

    return arrow_map(src, run, fields)
