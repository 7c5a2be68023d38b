"""Entries of lists looked up among the rows of their key, in the task where both lie.

The frame is partitioned and sorted by key: marks first, then the key's rows, then its lists. Arrow
batches pass one after another, and only marks and rows of the last key are held for the next batch. So
neither entries nor rows are sorted or grouped one by one. Functions that run in tasks are pickled by
value, so executors need no copy of the package on their path.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

#: What a row of the frame is.
MARKS, ROWS, LISTS = 0, 1, 2


def _codes(values: pa.Array) -> np.ndarray:
    """Equal values have equal numbers; there are no nulls."""
    return values.dictionary_encode().indices.to_numpy().astype(np.int64)


def _marked(words: pa.Array, word_keys: np.ndarray, keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether bit ``numbers`` is set in the words of ``keys``; a key without words has none."""
    size = pc.list_value_length(words).to_numpy()
    bits = np.append(words.flatten().to_numpy(), 0)
    begin, length = np.zeros((2, max(keys.max(initial=0), word_keys.max(initial=0)) + 1), np.int64)
    begin[word_keys], length[word_keys] = np.cumsum(size) - size, size
    word = numbers >> 6
    there = word < length[keys]
    return there & ((bits[np.where(there, begin[keys] + word, -1)] >> (numbers & 63)) & 1 == 1)


def lookup(key: str, kept: list[str], item: str, fields: list[str], values: list[str], bit: str | None, k: int | None):
    """The function for ``mapInArrow`` over rows (``key``, _kind, _item, _words, _row_<kept>, _list_<fields>, _value_<values>) to
    (``key``, _row_<kept>, _met_<fields and values>).

    The _met columns list, for a row with lists, every entry with the values of every row of its item. With ``k`` these are the k
    whose rows come first in the key's rows, in that order; else they stand as in the list. ``bit`` names the entries' number in
    _words. Every column is flat or a list of plain values: Spark writes nested ones many times slower.
    """

    def met_of(t: pa.Table, keys: np.ndarray, kind: np.ndarray) -> pa.RecordBatch | None:
        lists, rows = np.flatnonzero(kind == LISTS), np.flatnonzero(kind == ROWS)
        if not len(lists) or not len(rows):
            return None
        column = lambda name, at: t.column(name).combine_chunks().take(pa.array(at))
        listed = {f: column(f"_list_{f}", lists) for f in fields}
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(listed[item]).to_numpy())
        listed = {f: es.flatten() for f, es in listed.items()}
        usable = listed[item].is_valid().to_numpy(zero_copy_only=False)
        if bit:
            words = np.flatnonzero(kind == MARKS)
            usable = usable & _marked(column("_words", words), keys[words], keys[lists][row], listed[bit].to_numpy().astype(np.int64))
        usable = np.flatnonzero(usable)
        row = row[usable]
        codes = _codes(pa.concat_arrays([column("_item", rows), listed[item].take(pa.array(usable))]))
        n = codes.max(initial=0) + 1
        have, want = keys[rows] * n + codes[: len(rows)], keys[lists][row] * n + codes[len(rows) :]
        by = np.argsort(have, kind="stable")
        have = have[by]
        first = np.searchsorted(have, want)
        last = first + (have[np.minimum(first, len(have) - 1)] == want) if (have[1:] != have[:-1]).all() else np.searchsorted(have, want, "right")
        times = last - first
        at = np.repeat(np.arange(len(want)), times)
        place = by[np.repeat(first - (np.cumsum(times) - times), times) + np.arange(len(at))]
        if k is not None:
            best = np.argsort(row[at] * len(rows) + place, kind="stable")
            at, place = at[best], place[best]
            count = np.bincount(row[at], minlength=len(lists))
            ahead = np.arange(len(at)) - (np.cumsum(count) - count)[row[at]]
            at, place = at[ahead < k], place[ahead < k]
        count = np.bincount(row[at], minlength=len(lists))
        some = np.flatnonzero(count)
        if not len(some):
            return None
        ends = pa.array(np.append(0, np.cumsum(count[some])), pa.int32())
        met = [listed[f].take(pa.array(usable[at])) for f in fields] + [column(f"_value_{v}", rows[place]) for v in values]
        names = [key, *[f"_row_{c}" for c in kept]]
        found = [column(c, lists[some]) for c in names] + [pa.ListArray.from_arrays(ends, m) for m in met]
        return pa.RecordBatch.from_arrays(found, [*names, *[f"_met_{c}" for c in [*fields, *values]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            keys, kind = _codes(t.column(key).combine_chunks()), t.column("_kind").to_numpy()
            met = met_of(t, keys, kind)
            if met is not None:
                yield met
            held = t.take(pa.array(np.flatnonzero((keys == keys[-1]) & (kind != LISTS)))).combine_chunks()

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
