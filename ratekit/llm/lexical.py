"""Ranked lexical search: integer term impacts, pair-bound MaxScore over blocks of postings.

One pass over the documents writes a forward index: the number of terms of each document and,
of the terms that some item asks for, their numbers and occurrences. Document counts of
the terms are summed from it. A second pass turns every few thousand documents into a
block of posting lists with exact impacts, and ranks all items in it:

* Per term the block keeps the largest impact. Items order their terms by weight, the
  most frequent first, and neighbours in that order are term pairs. For every pair that an
  item asks for, the block precomputes the intersection of its two lists once, and keeps
  the largest joint impact and the k-th largest.
* The k-th largest joint impact is a lower bound of an item's k-th score, before a single
  document is scored; scores met in earlier blocks of the task raise it.
* A set of lists can add no more than the sum of its parts, where a part is one term (its largest
  impact) or one pair (its largest joint impact, or that of one of its terms alone). Of all
  ways to split the first j terms into such parts the smallest sum bounds them.
  The longest prefix whose bound stays below the threshold is not essential:
  documents that occur in these lists alone are never touched, and the others meet these lists
  one by one only while partial score and remaining bound reach the threshold. A block
  whose whole bound stays below is skipped.

Every score that is returned is exact, and no document that could be among the first k is left out.
A task returns at most k documents an item and block; they are ranked in two
rounds, so that no task meets what all others return.

Terms are compared by 64-bit hashes. The items are dealt into blocks of about ``max_item_bytes`` of text,
which are read by the driver and broadcast; each block of items passes over the documents.

Defined results: a document without terms, or with a null text, is not counted and never
found; rows with one doc_id are documents of their own, and equal scores and ids take
consecutive ranks; null ids come last among equal scores. Rows of one item_id are one item with the terms of
all; an item without terms has no rows. Empty tables give an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratekit.session import scratch_path

from .common import NON_WORD, arrow_map, as_block, blocks, text_bytes, words_of

# Fixed value: a term is a stretch of these; only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = {c: c + 32 for c in range(65, 91)}
TOP = 50
#: Postings of a block, and bytes of item text that are ranked in one pass.
BLOCK_POSTINGS, MAX_ITEM_BYTES = 1_000_000, 8_000_000

ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY r, doc_id, term),
size AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM size),
m AS (SELECT r, 50 + (50 * n * big_n) // big_l AS m FROM size, total),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, total GROUP BY term, big_n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS k
    FROM scored WHERE score > 0)
SELECT item_id, CAST(k AS INTEGER) AS "rank", doc_id, score FROM ranked WHERE k <= 50
"""


def terms_of(text: str | None) -> list[str]:
    return re.findall(TERM, (text or "").translate(_LOWER))


def number_terms(texts: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray]:
    """The term numbers of every item, and the terms' hashes, ascending by number."""
    words = sorted({w for ws in texts for w in ws})
    h = words_of(*as_block(words), NON_WORD).hashes["word"]
    order = np.argsort(h)
    number = {words[k]: n for n, k in enumerate(order.tolist())}
    return [np.array(sorted({number[w] for w in ws}), np.int64) for ws in texts], h[order]


def _forward(documents: DataFrame, hashes) -> DataFrame:
    """doc_id, n (its terms with repeats), terms (numbers, ascending) and tfs of every row."""
    src = documents.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        vocabulary = hashes.value
        size = max(len(vocabulary), 1)
        first = np.zeros(1 << 16, bool)  # most other words go by their first 16 bits
        first[vocabulary >> np.uint64(48)] = True
        for b in blocks(batches, "text"):
            data, offs = text_bytes(b.column("text"))
            w = words_of(data, offs, NON_WORD)
            h = w.hashes["word"]
            at = np.flatnonzero(first[h >> np.uint64(48)])
            k = np.minimum(np.searchsorted(vocabulary, h[at]), size - 1)
            hit = vocabulary[k] == h[at] if len(vocabulary) else np.zeros(0, bool)
            key, tf = np.unique(w.doc[at[hit]] * size + k[hit], return_counts=True)
            offsets = pa.array(np.searchsorted(key, np.arange(b.num_rows + 1) * size), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (key % size, tf)]
            cols = [b.column("doc_id"), pa.array(np.diff(w.first), pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n", "terms", "tfs"])

    return arrow_map(src, run, f"doc_id {id_type}, n long, terms array<int>, tfs array<int>")


def _document_counts(index: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; a task returns one row a term it met."""

    def run(batches):
        seen = np.zeros(size, np.int64)
        for b in batches:
            seen += np.bincount(_flat(b, "terms"), minlength=size)
        t = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(seen[t])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    found = arrow_map(index.select("terms"), run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in found.collect():  # at most one row a term of the item block
        out[r["term"]] = r["df"]
    return out


def _flat(b: pa.RecordBatch, column: str) -> np.ndarray:
    return b.column(column).flatten().to_numpy(zero_copy_only=False)


@dataclass
class Block:
    """Posting lists of some documents: ascending rows and impacts, by term."""

    n_rows: int
    first: np.ndarray  # start of each term's list
    rows: np.ndarray
    impact: np.ndarray
    largest: np.ndarray  # per term, 0 without a list
    joint: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)

    @staticmethod
    def of(n_rows: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int) -> Block:
        order = np.argsort(term, kind="stable")
        first = np.searchsorted(term[order], np.arange(n_terms + 1))
        impact = impact[order]
        largest = np.zeros(n_terms, np.int64)
        some = np.flatnonzero(np.diff(first))
        if len(some):
            largest[some] = np.maximum.reduceat(impact, first[some])
        return Block(n_rows, first, row[order], impact, largest)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.first[term], self.first[term + 1])
        return self.rows[span], self.impact[span]

    def intersect(self, pairs: list[tuple[int, int]], k: int) -> None:
        """Intersects the lists of every pair: largest and k-th largest joint impact (0 if there is none)."""
        value = np.full(self.n_rows, -1, np.int64)
        for a, b in pairs:
            rows_a, impact_a = self.postings(a)
            rows_b, impact_b = self.postings(b)
            value[rows_a] = impact_a
            other = value[rows_b]
            both = (other + impact_b)[other >= 0]
            value[rows_a] = -1
            kth = int(np.partition(both, -k)[-k]) if len(both) >= k else 0
            self.joint[a, b] = (int(both.max()) if len(both) else 0, kth)

    def prefix_bounds(self, terms: np.ndarray) -> np.ndarray:
        """Bound of the first j terms for every j: the cheapest split into terms and pairs of neighbours."""
        top = self.largest[terms].tolist()
        bound = [0]
        for j, t in enumerate(top):
            best = bound[j] + t
            if j:
                pair = max(self.joint[int(terms[j - 1]), int(terms[j])][0], top[j - 1], t)
                best = min(best, bound[j - 1] + pair)
            bound.append(best)
        return np.array(bound)

    def search(self, terms: np.ndarray, floor: int, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all documents that score ``floor`` or more; ``score`` is zeroed scratch."""
        bound = self.prefix_bounds(terms)
        free = int(np.searchsorted(bound, floor)) - 1  # the longest prefix below the floor
        if free == len(terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        for t in terms[free:]:
            rows, impact = self.postings(t)
            score[rows] += impact
        rows = np.flatnonzero(score >= floor - bound[free])
        got = score[rows]
        score[:] = 0
        for j in range(free - 1, -1, -1):
            held, impact = self.postings(terms[j])
            if len(held) and len(rows):
                at = np.minimum(np.searchsorted(held, rows), len(held) - 1)
                got = got + np.where(held[at] == rows, impact[at], 0)
                near = got >= floor - bound[j]
                rows, got = rows[near], got[near]
        return rows, got


def impacts(tf: np.ndarray, m: np.ndarray, w: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def item_orders(terms: list[np.ndarray], w: np.ndarray, df: np.ndarray) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """Every item's scoring terms by ascending weight, and the pairs of neighbours of all items."""
    orders = [t[(w[t] > 0) & (df[t] > 0)] for t in terms]
    orders = [t[np.lexsort((t, w[t]))] for t in orders]
    return orders, sorted({(int(a), int(b)) for t in orders for a, b in zip(t[:-1], t[1:])})


def _rank_blocks(index: DataFrame, asked, item_type: str, k: int, block_postings: int) -> DataFrame:
    """item_id, doc_id, score: at most k rows an item and block, all that may be among the item's first k."""
    id_type = index.schema["doc_id"].dataType.simpleString()

    def collect(batches):
        """Blocks of whole rows with about ``block_postings`` postings."""
        have, size = [], 0
        for b in batches:
            at = 0
            ends = b.column("terms").offsets.to_numpy()
            while at < b.num_rows:
                to = int(np.searchsorted(ends, ends[at] + block_postings - size, side="right")) - 1
                to = min(max(to, at + 1), b.num_rows)
                have.append(b.slice(at, to - at))
                size += int(ends[to] - ends[at])
                at = to
                if size >= block_postings or sum(x.num_rows for x in have) >= block_postings:
                    yield pa.Table.from_batches(have).combine_chunks().to_batches()[0]
                    have, size = [], 0
        if have:
            yield pa.Table.from_batches(have).combine_chunks().to_batches()[0]

    def run(batches):
        ids, terms_by_item, w, df, n_docs, n_terms = asked.value
        orders, pairs = item_orders(terms_by_item, w, df)
        best = [np.zeros(0, np.int64) for _ in orders]  # the k best scores met so far
        for b in collect(x for x in batches if x.num_rows):
            count = pc.list_value_length(b.column("terms")).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b.num_rows), count)
            n = b.column("n").to_numpy()
            m = 50 + (50 * n * n_docs) // n_terms
            term, tf = _flat(b, "terms").astype(np.int64), _flat(b, "tfs").astype(np.int64)
            block = Block.of(b.num_rows, row, term, impacts(tf, m[row], w[term]), len(w))
            block.intersect(pairs, k)
            by_id = np.empty(b.num_rows, np.int64)
            by_id[pc.sort_indices(b.column("doc_id"), null_placement="at_end").to_numpy()] = np.arange(b.num_rows)
            scratch = np.zeros(b.num_rows, np.int64)
            out_item, out_row, out_score = [], [], []
            for i, terms in enumerate(orders):
                if not len(terms):
                    continue
                floor = max([1, *(block.joint[int(x), int(y)][1] for x, y in zip(terms[:-1], terms[1:]))])
                if len(best[i]) == k:
                    floor = max(floor, int(best[i][0]))
                rows, got = block.search(terms, floor, scratch)
                if len(rows) > k:
                    first = np.lexsort((by_id[rows], -got))[:k]
                    rows, got = rows[first], got[first]
                best[i] = np.sort(np.r_[best[i], got])[-k:]
                out_item.append(np.full(len(rows), i))
                out_row.append(rows)
                out_score.append(got)
            if out_row and sum(map(len, out_row)):
                cols = [
                    ids.take(pa.array(np.concatenate(out_item))),
                    b.column("doc_id").take(pa.array(np.concatenate(out_row))),
                    pa.array(np.concatenate(out_score)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["item_id", "doc_id", "score"])

    return arrow_map(index.filter("size(terms) > 0"), run, f"item_id {item_type}, doc_id {id_type}, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every item, in two rounds: by item and salt, then by item."""
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    some = salted.withColumn("_k", F.row_number().over(Window.partitionBy("item_id", "_salt").orderBy(*best)))
    some = some.filter(F.col("_k") <= k).drop("_k", "_salt")
    whole = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best)))
    return whole.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(
    documents: DataFrame, items: DataFrame, k: int = TOP, max_item_bytes: int = MAX_ITEM_BYTES, block_postings: int = BLOCK_POSTINGS
) -> DataFrame:
    """item_id, rank, doc_id, score: every item's ``k`` best documents with a score above 0."""
    spark = documents.sparkSession
    asked = items.select("item_id", "text").filter("text IS NOT NULL")
    item_type = asked.schema["item_id"].dataType.simpleString()
    n_bytes = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(n_bytes / max_item_bytes))
    out = []
    for part in range(n_blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == part) if n_blocks > 1 else asked
        rows = mine.groupBy("item_id").agg(F.collect_set("text").alias("texts")).toArrow()  # about max_item_bytes
        terms, hashes = number_terms([terms_of("\n".join(t)) for t in rows["texts"].to_pylist()])
        path = scratch_path(spark, "postings")
        _forward(documents, spark.sparkContext.broadcast(hashes)).write.parquet(path)
        index = spark.read.parquet(path)
        total = index.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        df = _document_counts(index, len(hashes))
        ids = rows["item_id"].combine_chunks()
        known = (ids, terms, weights(df, total["docs"]), df, total["docs"], total["terms"] or 1)
        out.append(_rank_blocks(index, spark.sparkContext.broadcast(known), item_type, k, block_postings))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return _first(found, k)
