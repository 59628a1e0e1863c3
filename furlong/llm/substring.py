"""Substring deduplication by suffix automata of reference shards.

The shards' references are the distinct regions of :mod:`furlong.llm.repeats`, each with its number of copies.
A task builds the suffix automaton of a shard's reference, with the number of occurrences per state, and the
regions stream through it for their matching statistics: the state of the last ``length`` words tells how
often that word sequence occurs. Documents lose every word that lies in a sequence which occurs again.

References of a whole corpus are not of bounded size, so automata are not sent to every executor: each stays
in the task of its shard, and the regions that can match in it come there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm import text as T
from furlong.llm.blocks import Blocks, texts_of
from furlong.llm.repeats import Parts, Rule, covered, repeats

LENGTH = 35
GRAM = 12
BLOCK_BYTES = 2 << 20


class Automaton:
    """Suffix automaton of several sequences; ``counts`` holds weighted occurrences of each state's strings."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.counts = [-1], [0], [0]

    def _clone(self, state: int, symbol: int, target: int) -> int:
        """A copy of ``target`` for strings that end with ``symbol`` after ``state``."""
        nxt, link = self.next, self.link
        copy = len(nxt)
        nxt.append(nxt[target].copy())
        link.append(link[target])
        self.length.append(self.length[state] + 1)
        self.counts.append(0)
        link[target] = copy
        while state >= 0 and nxt[state].get(symbol) == target:
            nxt[state][symbol] = copy
            state = link[state]
        return copy

    def add(self, sequence: list[int], weight: int) -> None:
        nxt, link, length, counts = self.next, self.link, self.length, self.counts
        last = 0
        for symbol in sequence:
            target = nxt[last].get(symbol)
            if target is not None:
                here = target if length[target] == length[last] + 1 else self._clone(last, symbol, target)
            else:
                here, state = len(nxt), last
                nxt.append({})
                length.append(length[last] + 1)
                counts.append(0)
                link.append(0)
                while state >= 0 and symbol not in nxt[state]:
                    nxt[state][symbol] = here
                    state = link[state]
                if state >= 0:
                    target = nxt[state][symbol]
                    link[here] = target if length[target] == length[state] + 1 else self._clone(state, symbol, target)
            counts[here] += weight
            last = here

    def finish(self) -> None:
        """Add up occurrences along suffix links, longest strings first."""
        counts, link = self.counts, self.link
        for state in np.argsort(-np.array(self.length), kind="stable").tolist():
            if link[state] > 0:
                counts[link[state]] += counts[state]

    def occurrences(self, sequence: list[int], n: int) -> list[int]:
        """How often each run of ``n`` symbols of a sequence that was added occurs."""
        nxt, link, length, counts = self.next, self.link, self.length, self.counts
        state, out = 0, []
        for at, symbol in enumerate(sequence):
            state = nxt[state][symbol]
            while length[link[state]] >= n:
                state = link[state]
            if at >= n - 1:
                out.append(counts[state])
        return out


def _words(table: pa.Table):
    raw, offsets = T.buffer_of(texts_of(table))
    starts, ends, per = T.words_of(raw, offsets)
    hashed = T.word_hashes(raw, starts, ends)
    return hashed, hashed, per, (raw, offsets, starts, ends)


def _again(length: int):
    def repeated(words: np.ndarray, sizes: np.ndarray, copies: np.ndarray) -> np.ndarray:
        _, symbols = np.unique(words, return_inverse=True)
        symbols, bounds = symbols.tolist(), np.append(0, np.cumsum(sizes)).tolist()
        automaton = Automaton()
        for a, b, w in zip(bounds, bounds[1:], copies.tolist(), strict=False):
            automaton.add(symbols[a:b], w)
        automaton.finish()
        out: list[int] = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            out += automaton.occurrences(symbols[a:b], length)
        return np.array(out, np.int64) > 1
    return repeated


def rule(length: int = LENGTH, gram: int = GRAM) -> Rule:
    return Rule(
        length, min(gram, length), "<u8", "<u4", _words,
        lambda place, docs, table, n: np.bincount(place, minlength=n),
        lambda place, sums, n: np.bincount(place, sums, n).astype(np.int64),
        _again(length), lambda flags, all_copies, own: flags,
        lonely=lambda copies, n_blocks: copies == 1, first_stays=False, shards_per_block=1)


def _kept_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, per: np.ndarray,
                kept: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """(bytes of kept words joined by one space, offsets per document)."""
    at = np.flatnonzero(kept)
    owner = T.owners(per, at)
    follows = np.zeros(len(at), bool)
    follows[:-1] = owner[1:] == owner[:-1]
    out = raw.copy()
    out[ends[at[follows]]] = 0x20
    # After a word that another one follows there is at least one space byte.
    depth = np.zeros(len(raw) + 1, np.int8)
    depth[starts[at]] += 1
    stop = ends[at] + follows
    np.subtract.at(depth, stop, 1)
    inside = np.cumsum(depth[:-1], dtype=np.int8) > 0
    sizes = (stop - starts[at])
    per_doc = np.bincount(owner, sizes, len(per) - 1).astype(np.int64)
    return memoryview(out[inside].tobytes()), np.append(0, np.cumsum(per_doc))


def _finish(length: int, keep_text: bool, carry: bool):
    def finish(block: int, table: pa.Table, parts: Parts, starts_of: np.ndarray) -> pa.Table:
        raw, offsets, starts, ends = parts.more
        per, docs = parts.offsets, table.num_rows
        removed = covered(starts_of, length, len(starts))
        gone = np.append(0, np.cumsum(removed))
        n_removed = gone[per[1:]] - gone[per[:-1]]
        kept, cuts = _kept_words(raw, starts, ends, per, ~removed)
        digests = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        out = {"doc": table.column("doc"), "n_words": pa.array(np.diff(per)), "n_removed": pa.array(n_removed),
               "kept_sha256": pa.array(digests, pa.string())}
        if carry:
            out["carried"] = table.column("carried")
        if keep_text:
            # A removed word goes with the space up to the next word; all else stays as it is.
            follow = np.append(starts[1:], len(raw))
            last = per[1:][np.diff(per) > 0] - 1
            follow[last] = offsets[1:][np.diff(per) > 0]
            depth = np.zeros(len(raw) + 1, np.int64)
            np.add.at(depth, starts[removed], 1)
            np.add.at(depth, follow[removed], -1)
            stays = np.cumsum(depth)[:len(raw)] == 0
            left = np.append(0, np.cumsum(stays))[offsets]
            data = raw[stays].tobytes()
            texts = pa.LargeStringArray.from_buffers(docs, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(data))
            out["text"] = texts.cast(pa.string())
        return pa.table(out)
    return finish


def without_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text",
                    keep_text: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: ``key, n_words, n_removed, kept_sha256``, and the remaining text if asked for.

    Columns named in ``carry`` come along in a struct ``carried``.

    A word is a run of characters other than space and 0x09-0x0D. It is removed if it lies in a run of
    ``length`` consecutive words that also starts anywhere else in the corpus, the same document included;
    overlapping runs count, and runs are judged on the input. All copies go. Null and empty texts have no
    words and stay; shorter texts lose nothing. Repeated rows are copies of each other; null keys stay null.
    Other columns are ignored; an empty table gives no rows. Words are compared by 64-bit hashes.
    """
    columns = [F.col(key).cast("long").alias("doc"), F.col(text).alias("__text")]
    if carry:
        columns.append(F.struct(*carry).alias("carried"))
    rows = docs.select(*columns)
    blocks = Blocks(rows, "__text", ["doc", "carried"] if carry else ["doc"], BLOCK_BYTES)
    schema = "doc long, n_words long, n_removed long, kept_sha256 string"
    schema += f", carried {rows.schema['carried'].dataType.simpleString()}" if carry else ""
    schema += ", text string" if keep_text else ""
    return repeats(blocks, rule(length), _finish(length, keep_text, bool(carry)), schema).withColumnRenamed("doc", key)
