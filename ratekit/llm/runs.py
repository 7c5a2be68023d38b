"""Periodic runs of words by string synchronising sets, and their removal.

A run is a stretch of consecutive words with smallest period q and at least
max(12, 2q) words that no neighbouring word extends keeping period q. Words are
numbered per document, and names of all stretches of 1, 2, 4, ... words are made by
doubling: equal names, equal words. So every comparison is exact, and the longest
common extension of two positions takes one step a level. A stretch that occurs once
in its document has a name of its own and is followed no further; where no stretch
of some length is repeated, no longer period exists.

Periods below ``DIRECT`` are read off the repeated stretches of four words: position
i and i + q have one name. Above, a run of period 4t <= q < 8t (t a power of two) is met
at scale t:

* Synchronising positions: i is chosen if the hash of the name of t words is smallest at i
  or at i + t among i, ..., i + t. The choice depends on 2t words only, so equal contexts
  are chosen alike, and every t consecutive positions hold one that is chosen.
* Chosen positions with equal contexts of 2t words, 4t to 8t apart, propose their distance.
  A context whose period exceeds t/3 occurs only a bounded number of times in that distance.
* Contexts with a period of t/3 or less lie in regions, runs that the smaller scales have
  found, and are left out. If all contexts of a run are left out, its first period lies in
  one region and the next in another: the distance of their starts or of their ends is
  the period, or the regions touch and have one root, and then every distance that
  aligns the roots is proposed.

Every proposal is extended by the names to its whole stretch and kept if long
enough; of one stretch the smallest period stays. So the result is exact, and the
work is n log n but for the output.

Defined results: null and empty texts have no words and no runs. Documents are independent; a
document lies whole in one task. Repeated rows come out as they are. A null id is not
rewritten by the query's planted periods. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, arrow_map, blocks, mix64

MIN_WORDS = 12
#: Periods below this are read off repeated stretches; the scales start at DIRECT / 4.
DIRECT = 32


@dataclass
class Names:
    """Names of the stretches of 2^k words at every position; repeated stretches count from 0."""

    level: list[np.ndarray]
    repeated: list[np.ndarray]  # positions whose stretch of 2^k words occurs elsewhere too

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal words from x and y on."""
        n, got = len(self.level[0]), np.zeros(len(x), np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            name = self.level[k]
            a, b = np.minimum(x + got, n - 1), np.minimum(y + got, n - 1)
            got += ((y + got < n) & (name[a] == name[b])).astype(np.int64) << k
        return got

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal words just before x and y."""
        got = np.zeros(len(x), np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            name, size = self.level[k], 1 << k
            a, b = x - got - size, y - got - size
            got += ((a >= 0) & (name[np.maximum(a, 0)] == name[np.maximum(b, 0)])).astype(np.int64) << k
        return got


def _name(keys: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all n positions from the keys of positions ``at``, and the repeated positions."""
    name = np.arange(-1, -n - 1, -1, dtype=np.int64)  # alone: a name of its own
    if len(at):
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        new = np.r_[True, k[1:] != k[:-1]]
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        name[at[order[many]]] = group[many]
        at = np.sort(at[order[many]])
    return name, at


def name_stretches(words: np.ndarray) -> Names:
    """``words``: numbers that differ between documents."""
    n = len(words)
    name, at = _name(words, np.arange(n), n)
    out = Names([name], [at])
    size = 1
    while len(at):
        # both halves must be repeated for the whole to be
        both = at[(at + size < n)]
        both = both[name[both + size] >= 0]
        name, at = _name(name[both] * n + name[both + size], both, n)
        size *= 2
        if len(at):
            out.level.append(name)
            out.repeated.append(at)
    return out


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of h[i : i + width], for every i with a whole window."""
    have, out = 1, h
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _chosen(name: np.ndarray, t: int) -> np.ndarray:
    """Whether each position is synchronising at scale t, by the names of t words."""
    h = mix64(name.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros(len(h), bool)
    if len(h) > t:
        low = _window_min(h, t + 1)
        out[: len(low)] = (h[: len(low)] == low) | (h[t:] == low)
    return out


def _pairs(group: np.ndarray | None, at: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, index) of positions of one group (ascending within it) that are lo <= d < hi apart."""
    first, second, step = [], [], 1
    left = np.arange(len(at) - 1)
    while len(left):
        left = left[left + step < len(at)]
        near = at[left + step] - at[left] < hi
        if group is not None:
            near &= group[left + step] == group[left]
        left = left[near]
        far = at[left + step] - at[left] >= lo
        first.append(left[far])
        second.append(left[far] + step)
        step += 1
    if not first:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(first), np.concatenate(second)


class _Found:
    """Runs met so far: of one stretch the smallest period."""

    def __init__(self, names: Names):
        self.names = names
        self.start = self.end = self.period = np.zeros(0, np.int64)

    def add(self, x: np.ndarray, q: np.ndarray) -> None:
        """Extends proposals: words x and x + q lie in a stretch of period q."""
        if not len(x):
            return
        base = len(self.names.level[0]) + 1
        x, q = np.divmod(np.unique(x * base + q), base)
        start = x - self.names.backward(x, x + q)
        end = x + q + self.names.forward(x, x + q)
        ok = end - start >= np.maximum(MIN_WORDS, 2 * q)
        s = np.r_[self.start, start[ok]]
        e = np.r_[self.end, end[ok]]
        p = np.r_[self.period, q[ok]]
        order = np.lexsort((p, e, s))
        s, e, p = s[order], e[order], p[order]
        keep = np.r_[True, (s[1:] != s[:-1]) | (e[1:] != e[:-1])] if len(s) else np.zeros(0, bool)
        self.start, self.end, self.period = s[keep], e[keep], p[keep]


def _direct(names: Names, found: _Found) -> None:
    """Periods below DIRECT. A run has at least 6 words and a period more, so 4 repeated ones."""
    at, name = names.repeated[2], names.level[2]
    n, xs, qs = len(name), [], []
    for q in range(1, DIRECT):
        i = at[at + q < n]
        i = i[name[i] == name[i + q]]
        i = i[np.r_[True, i[1:] != i[:-1] + 1]] if len(i) else i
        xs.append(i)
        qs.append(np.full(len(i), q))
    found.add(np.concatenate(xs), np.concatenate(qs))


def _contexts(names: Names, found: _Found, level: int, t: int) -> None:
    """Equal contexts of 2t words at chosen positions, 4t to 8t apart, outside regions."""
    n = len(names.level[0])
    name = names.level[level + 1]
    at = names.repeated[level + 1]
    at = at[_chosen(names.level[level], t)[at]]
    region = (3 * found.period <= t) & (found.end - found.start >= 2 * t)
    inside = np.zeros(n + 1, np.int64)
    np.add.at(inside, found.start[region], 1)
    np.add.at(inside, found.end[region] - 2 * t + 1, -1)
    at = at[np.cumsum(inside)[at] == 0]
    order = np.lexsort((at, name[at]))
    at = at[order]
    a, b = _pairs(name[at], at, 4 * t, 8 * t)
    found.add(at[a], at[b] - at[a])


def _regions(names: Names, found: _Found, t: int) -> None:
    """Periods between regions (runs of 2t words or more with a period of t/3 or less)."""
    pick = (3 * found.period <= t) & (found.end - found.start >= 2 * t)
    s, e, p = found.start[pick], found.end[pick], found.period[pick]
    if len(s) < 2:
        return
    xs, qs = [], []
    for at, back in ((np.sort(s), 0), (np.sort(e), 1)):  # starts; last words
        a, b = _pairs(None, at, 4 * t, 8 * t)
        xs.append(at[a] - back)
        qs.append(at[b] - at[a])
    # touching neighbours of one period: align their roots
    order = np.lexsort((s, p))
    s, e, p = s[order], e[order], p[order]
    for k in np.flatnonzero((p[1:] == p[:-1]) & (s[1:] <= e[:-1])):
        s1, e1, s2, e2, per = s[k], e[k], s[k + 1], e[k + 1], int(p[k])
        size = per.bit_length() - 1
        name, tail = names.level[size], per - (1 << size)
        shift = np.arange(per)
        same = (name[s2 + shift] == name[s1]) & (name[s2 + shift + tail] == name[s1 + tail])
        for d in np.flatnonzero(same):
            q = np.arange((s2 + d - s1) % per, 8 * t, per)
            q = q[q >= 4 * t]
            x = np.maximum(s1, s2 - q)
            ok = np.minimum(e1, e2 - q) - x >= q
            xs.append(x[ok])
            qs.append(q[ok])
    found.add(np.concatenate(xs), np.concatenate(qs))


def find_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of every run, by start and then period.

    ``words``: word numbers of one document, or of several one after another whose
    numbers differ between documents.
    """
    words = np.asarray(words, np.int64)
    if len(words) < MIN_WORDS:
        z = np.zeros(0, np.int64)
        return z, z, z
    names = name_stretches(words)
    found = _Found(names)
    if len(names.level) > 2:
        _direct(names, found)
    level = DIRECT.bit_length() - 3
    while level + 2 < len(names.level):  # some 4t words are repeated
        t = 1 << level
        _contexts(names, found, level, t)
        _regions(names, found, t)
        level += 1
    order = np.lexsort((found.period, found.start))
    return found.start[order], found.end[order], found.period[order]


def plant(words: np.ndarray, h: int | None) -> np.ndarray:
    """The query's rewriting: every tenth document repeats a stretch of its words to its end."""
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return words[np.where(i < a, i, a + (i - a) % p)]


def _number(texts: list[bytes], hashes: list[int | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word numbers of all texts (different ones in each), the texts' first words, the words by number."""
    parts, words, first = [], [], [0]
    for data, h in zip(texts, hashes):
        seen: dict[bytes, int] = {}
        base = len(words)
        # bytes.split() cuts at exactly 0x20 and 0x09-0x0D
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in data.split()), np.int64)
        words += seen
        parts.append(plant(ids, h) + base)
        first.append(first[-1] + len(ids))
    return np.concatenate(parts), np.asarray(first), words


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _kept(n: int, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """True for words that no run holds after its first period."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, end, -1)
    return np.cumsum(cover[:-1]) == 0


_FIELDS = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def document_runs(documents: DataFrame, planted: bool = False, details: bool = False) -> DataFrame:
    """Runs of every document and the text without repeated periods, as digests.

    doc_id, n_runs; start, length, period and exponent_milli of the longest run (ties: smallest
    start, then period; nulls without a run); runs_sha256 over ``start,length,period`` lines;
    collapsed_sha256 over the kept words joined by one space. ``planted`` rewrites
    every tenth document first (see :func:`plant`). ``details`` adds runs, an array of
    structs, and collapsed, the text.
    """
    no_id = F.col("doc_id").isNull()
    h = F.when(~no_id, F.crc32(F.col("doc_id").cast("string").cast("binary")))
    src = documents.select("doc_id", "text", (h if planted else F.lit(None).cast("bigint")).alias("_h"))
    fields = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {_FIELDS}"
    if details:
        fields += ", runs array<struct<start:long,length:long,period:long>>, collapsed string"
    schema = [c.strip().split(" ")[0] for c in f"doc_id x, {_FIELDS}".split(",")] + ["runs", "collapsed"] * details

    def run(batches):
        for b in blocks(batches, "text", BLOCK_BYTES):
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            ids, first, words = _number(texts, b.column("_h").to_pylist())
            start, end, period = find_runs(ids)
            kept = _kept(len(ids), start, end, period)
            doc = np.searchsorted(first, start, side="right") - 1
            cut = np.searchsorted(doc, np.arange(len(texts) + 1))
            rows: list[list] = [[] for _ in schema[1:]]
            for k in range(len(texts)):
                lo, hi, at = cut[k], cut[k + 1], first[k]
                s, q = start[lo:hi] - at, period[lo:hi]
                size = end[lo:hi] - start[lo:hi]
                best = [None] * 4
                if hi > lo:
                    j = np.lexsort((q, s, -size))[0]
                    best = [int(s[j]), int(size[j]), int(q[j]), int(1000 * size[j] // q[j])]
                lines = list(zip(s.tolist(), size.tolist(), q.tolist()))
                own = ids[at : first[k + 1]][kept[at : first[k + 1]]]
                text = b" ".join(map(words.__getitem__, own.tolist()))
                row = [hi - lo, *best, _sha(b"".join(b"%d,%d,%d\n" % x for x in lines)), _sha(text)]
                if details:
                    row += [[dict(zip(("start", "length", "period"), x)) for x in lines], text.decode()]
                for out, v in zip(rows, row):
                    out.append(v)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            if details:
                kinds += [pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])), pa.string()]
            cols = [b.column("doc_id")] + [pa.array(v, t) for v, t in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays(cols, names=schema)

    return arrow_map(src, run, fields)
