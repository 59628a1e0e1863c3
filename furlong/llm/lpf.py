"""Byte substring deduplication by longest-previous-factor arrays.

A shard's distinct regions (:mod:`furlong.llm.repeats`) stand in the order of the smallest document that has
them. Its window positions are sorted into suffix order; the previous and the next position in that order with
a smaller document give the longest earlier match. A window is a later copy if that match covers it. The first
document's copy stays, later ones go.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm import text as T
from furlong.llm.blocks import Blocks, flat_ranges, named, texts_of
from furlong.llm.repeats import Parts, Rule, covered, document_keys, repeats

LENGTH = 50
GRAM = 16
BLOCK_BYTES = 2 << 20


def _bytes(table: pa.Table):
    raw, offsets = T.buffer_of(texts_of(table))
    return T.BYTE_VALUES[raw], raw, offsets, None


def smallest(place: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, 2**63 - 1, np.int64)
    np.minimum.at(out, place, values)
    return out


def previous_smaller(values: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """For each position the nearest earlier one at or after ``floor`` with a smaller value, else ``floor - 1``.

    Positions jump over what the position they look at has already jumped over.
    """
    at = np.arange(len(values)) - 1
    while True:
        go = np.flatnonzero(at >= floor)
        go = go[values[at[go]] >= values[go]]
        if not len(go):
            return np.maximum(at, floor - 1)
        at[go] = at[at[go]]


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded, 0, (1,))


def earlier_match(data: np.ndarray, starts: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes at each start also stand at a start of a smaller document.

    The suffixes are ordered by their first ``length`` bytes, all that a match of that length can depend on;
    neighbours agree in all of them exactly if their longest common prefix is that long.
    """
    out = np.zeros(len(starts), bool)
    # Equal windows share a place in the order, and one that is alone has no match: one of each set of equal
    # ones is sorted, the others are compared with it byte by byte.
    names = T.spanned(T.rolled(T.BYTE_VALUES[data]), starts, starts + length)
    _, first, place = named(names)
    several = np.bincount(place, minlength=len(first)) > 1
    rows = np.flatnonzero(several[place])
    if not len(rows):
        return out
    heads = starts[first[several]]
    text = np.lib.stride_tricks.sliding_window_view(data, length)[heads]
    ranks = np.empty(len(heads), np.int64)
    ranks[np.argsort(np.ascontiguousarray(text).view(f"S{length}").ravel(), kind="stable")] = np.arange(len(heads))
    mine = (np.cumsum(several) - 1)[place[rows]]
    at, head = starts[rows], heads[mine]
    same = np.ones(len(rows), bool)
    eight = _eights(data)
    for step in [*range(0, length - 8, 8), max(0, length - 8)]:
        same &= eight[at + step] == eight[head + step]
    rows, mine = rows[same], mine[same]
    docs = docs[rows]
    order = np.argsort(ranks[mine], kind="stable")
    rank = ranks[mine][order]
    begins = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
    floor = np.repeat(begins, np.diff(np.append(begins, len(order))))
    ceiling = np.repeat(np.append(begins[1:], len(order)), np.diff(np.append(begins, len(order))))
    value = docs[order]
    before = previous_smaller(value, floor) >= floor
    n = len(order)
    after = previous_smaller(value[::-1], (n - ceiling)[::-1])[::-1] >= n - ceiling
    out[rows[order]] = before | after
    return out


def _later(length: int):
    def repeated(data: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
        begins, count = np.cumsum(sizes) - sizes, sizes - length + 1
        return earlier_match(data, flat_ranges(begins, count), np.repeat(docs, count), length)
    return repeated


def rule(length: int = LENGTH, gram: int = GRAM) -> Rule:
    return Rule(
        length, min(gram, length), "u1", "<i8", _bytes,
        lambda place, docs, table, n: smallest(place, document_keys(table)[docs], n), smallest,
        _later(length), lambda flags, first, own: flags | (own > first), lonely=lambda first, n_blocks: n_blocks == 1,
        first_stays=True, shards_per_block=0.5)


def _finish(length: int, keep_bytes: bool):
    def finish(block: int, table: pa.Table, parts: Parts, starts_of: np.ndarray) -> pa.Table:
        raw, offsets = parts.sent, parts.offsets
        removed = covered(starts_of, length, len(raw))
        gone = np.searchsorted(np.flatnonzero(removed), offsets)
        head = removed.copy()
        head[1:] &= ~removed[:-1]
        cuts = offsets[:-1][np.diff(offsets) > 0]
        head[cuts] = removed[cuts]
        spans = np.searchsorted(np.flatnonzero(head), offsets)
        left = offsets - gone
        kept = memoryview(raw[~removed].tobytes())
        pieces = [kept[a:b] for a, b in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)]
        out = {"doc": table.column("doc"), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(np.diff(gone)),
               "n_spans": pa.array(np.diff(spans)),
               "kept_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string())}
        if keep_bytes:
            out["kept"] = pa.array([bytes(p) for p in pieces], pa.binary())
        return pa.table(out)
    return finish


def without_later_copies(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text",
                         keep_bytes: bool = False) -> DataFrame:
    """One row per document: ``key, n_bytes, n_removed, n_spans, kept_sha256``, and the kept bytes if asked for.

    A byte of the UTF-8 text is removed if it lies in a string of ``length`` bytes that also starts in a
    document with a smaller key; overlapping strings count, and strings are judged on the input. Matches never
    cross documents. Null texts are empty; shorter texts lose nothing. Rows with equal keys do not remove each
    other's bytes. A null key is larger than all others. Other columns are ignored; an empty table gives no rows.
    """
    blocks = Blocks(docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("__text")), "__text", ["doc"],
                    BLOCK_BYTES)
    schema = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return repeats(blocks, rule(length), _finish(length, keep_bytes), schema).withColumnRenamed("doc", key)
