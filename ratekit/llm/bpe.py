"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

Merging adjacent pairs in rank order has a property that makes it a left-to-right
problem: a token sequence is the encoding of its bytes exactly if every two
neighbours are the encoding of theirs. So every prefix of a piece has one possible
last token: of the tokens that end there (found by a suffix-link automaton over
the vocabulary) the only one that is compatible with the last token of the prefix
before it. The pass stores that token for every prefix; following the tokens back from
the end gives the exact ids. A pair is compatible if merging its bytes gives
the pair back. Both tokens grow by merges of rising rank; the test walks the symbols that
touch, from the two bytes at the border to the whole tokens, in the order of these ranks and
asks whether a merge across the border would come first. Results of these tests are
kept, as are the ids of short pieces.

Text is first cut at the special token's string and then into pieces by the
tokenizer's pattern, as the vocabulary file prescribes. Decoding joins the
tokens' bytes and reads them as UTF-8.

Defined results: null is the empty text: no tokens, and the hashes of empty texts.
Very long pieces take time linear in their length. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import BLOCK_BYTES, arrow_map, blocks

# Fixed value: the piece pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bounds of a worker's kept results (pieces: of each of two generations; a full store of pairs starts anew).
KEEP_PIECES, KEEP_PAIRS, KEEP_LENGTH = 200_000, 1_000_000, 48
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if printable, else the next free above 255."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = {}, 256
    for b in range(256):
        if b in shown:
            out[chr(b)] = b
        else:
            out[chr(free)] = b
            free += 1
    return out


class Pieces(dict):
    """Ids of pieces, found on first use; long pieces are not kept.

    A full store becomes the older generation; pieces met again move back, so the
    frequent ones stay while the others go.
    """

    def __init__(self, find):
        super().__init__()
        self.find = find
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.find(piece)
            if len(piece) > KEEP_LENGTH:
                return ids
        if len(self) >= KEEP_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Encoder and decoder of one vocabulary file (JSON text)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        raw = lambda s: bytes(letters[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for s, i in vocab.items():
            self.bytes_of[i] = raw(s)
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        self.name_of = [str(i) for i in range(size)]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merge[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.single = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        reached = {new for _, new in self.merge.values()} | set(self.single)
        # the merge that makes each token; the walk needs one a token, after those of its parts
        self.made: dict[int, tuple[int, int, int]] = {}
        self.walks, single = True, set(self.single)
        for (a, b), (rank, new) in self.merge.items():
            late = any(self.made.get(x, (-1,))[0] > rank or (x not in self.made and x not in single) for x in (a, b))
            self.walks = self.walks and new not in self.made and not late
            self.made[new] = (rank, a, b)
        self.rank_of = {a << 20 | b: rank for (a, b), (rank, _) in self.merge.items()}
        self.ends: dict[int, tuple] = {}
        self.starts: dict[int, tuple] = {}
        self.auto = ahocorasick.Automaton()
        for i in reached:
            s = self.bytes_of[i].decode("latin-1")
            if len(s) == 1 or self.merged(self.bytes_of[i]) == [i]:
                self.auto.add_word(s, (len(s), i))
        self.auto.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pieces = Pieces(self.piece)
        self.find = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def merged(self, data: bytes) -> list[int]:
        """Ids by merging the adjacent pair of lowest rank, leftmost first, until none is left."""
        seq = [self.single[b] for b in data]
        merge = self.merge
        while len(seq) > 1:
            ranked = [(merge[p][0], k) for k, p in enumerate(zip(seq, seq[1:])) if p in merge]
            if not ranked:
                break
            k = min(ranked)[1]
            seq[k : k + 2] = [merge[seq[k], seq[k + 1]][1]]
        return seq

    def _spine(self, token: int, side: int, kept: dict[int, tuple]) -> tuple:
        """(symbol, rank at which it grows) at the end (side 2) or start (side 1) of a token, from byte to token."""
        out = kept.get(token)
        if out is None:
            out, grows, x = [], NEVER, token
            while x in self.made:
                out.append((x, grows))
                grows, x = self.made[x][0], self.made[x][side]
            out.append((x, grows))
            out = kept[token] = tuple(reversed(out))
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both tokens gives the two back."""
        if not self.walks:
            return self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        left, right, rank_of = self._spine(a, 2, self.ends), self._spine(b, 1, self.starts), self.rank_of
        i = j = 0
        while True:
            x, x_grows = left[i]
            y, y_grows = right[j]
            rank = rank_of.get(x << 20 | y, NEVER)
            # of equal merges the leftmost goes first
            if rank < x_grows and rank <= y_grows and rank < NEVER:
                return False
            if x_grows <= y_grows:
                if x_grows == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece: the last token of every prefix, then back from the end."""
        data = text.encode().decode("latin-1")
        size_all = len(data)
        last: list[int] = [-1] * (size_all + 1)
        back: list[int] = [0] * (size_all + 1)
        pairs = self.pairs
        for end, (size, token) in self.auto.iter(data):
            at = end + 1
            if last[at] >= 0:
                continue
            before = at - size
            if before:
                prior = last[before]
                if prior < 0:
                    continue
                key = prior << 20 | token
                ok = pairs.get(key)
                if ok is None:
                    if len(pairs) >= KEEP_PAIRS:
                        pairs.clear()
                    ok = pairs[key] = self.compatible(prior, token)
                if not ok:
                    continue
            last[at], back[at] = token, before
        out, at = [], size_all
        while at:
            out.append(last[at])
            at = back[at]
        out.reverse()
        return tuple(out)

    def _ids(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.find(text))))

    def encode(self, text: str) -> list[int]:
        if self.cut is None or not any(s in text for s in self.special):
            return self._ids(text)
        out: list[int] = []
        for k, part in enumerate(self.cut.split(text)):
            out += [self.special[part]] if k % 2 else self._ids(part)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def load(text: str) -> Encoder:
    """The worker's encoder of a vocabulary, made once in a Python process."""
    store = sys.modules.setdefault("_ratekit_encoders", types.ModuleType("_ratekit_encoders")).__dict__
    name = hashlib.sha256(text.encode()).hexdigest()
    if name not in store:
        store[name] = Encoder(text)
    return store[name]


def encode_documents(documents: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, and ids if asked for.

    ``vocabulary``: path of a byte-level BPE file on the driver; its text (some MB) is
    broadcast to the executors.
    """
    spark = documents.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        text = spark.sparkContext.broadcast(f.read())
    src = documents.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches):
        enc = load(text.value)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for b in blocks(batches, "text", BLOCK_BYTES):
            n, ids_sha, decoded_sha, all_ids = [], [], [], []
            for t in b.column("text").to_pylist():
                ids = enc.encode(t or "")
                n.append(len(ids))
                ids_sha.append(sha(",".join(map(enc.name_of.__getitem__, ids)).encode()))
                decoded_sha.append(sha(enc.decode(ids).encode()))
                if with_ids:
                    all_ids.append(ids)
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
            cols += [pa.array(all_ids, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in fields.split(", ")])

    return arrow_map(src, run, fields)
