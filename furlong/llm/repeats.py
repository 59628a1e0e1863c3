"""Where strings of a fixed length occur more than once in a corpus, as an exchange of blocks and shards.

A text is a sequence of symbols (words or bytes). Of every window of ``length`` symbols the smallest of its
gram hashes is the window's anchor. It depends on the window alone, so equal windows have equal anchors; and
neighbouring windows mostly share one, so a run of windows with their anchor at one place is a *region*. Only anchors that
occur twice or more can hold a repeated window. Their distinct regions meet in a shard, each with the summary
of all its copies, and the shard's index tells for every window whether it is repeated.

1. Blocks send their anchors with counts to shards, which return the ones that occur more than once.
2. Blocks send hash and summary of each distinct region with such an anchor. An anchor with more than ``HOT``
   occurrences sends single windows instead, dealt by their own hash, so that no shard holds a hot anchor.
3. Shards ask one block for the symbols of each distinct region, index them and answer all blocks.
4. Blocks mark the repeated windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from furlong.llm import text as T
from furlong.llm.blocks import Blocks, flat_ranges, joined, named, shards, split_by, unpacked, written

HOT = 4096
#: Windows worked on at once, so that arrays of numbers about them stay in a core's cache.
STRETCH = 1 << 15
ONE = np.uint64(1)


@dataclass(frozen=True)
class Rule:
    """What is compared and how copies are summed up; all functions work on arrays."""
    length: int
    gram: int
    unit: str  # kind of the symbols sent
    summary: str  # kind of a region's summary
    symbols: Callable  # rows -> (hashed symbols, symbols to send, offsets, anything for the finish)
    summarise: Callable  # (region of each occurrence, occurrences' documents, rows, number of regions) -> summaries
    combine: Callable  # (region of each entry, summaries, number of regions) -> summaries
    repeated: Callable  # (symbols, lengths, summaries) -> flag per window
    answer: Callable  # (flags, regions' summaries, the block's own summaries), per window -> flags
    lonely: Callable  # (summaries, number of blocks that have the region) -> whether it has no copy elsewhere
    first_stays: bool
    shards_per_block: float = 1


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` consecutive values."""
    total, have, out = len(x) - n + 1, 1, x
    while have * 2 <= n:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:total], out[n - have:n - have + total])


def stretches(n: int) -> Iterator[tuple[int, int]]:
    """Ranges that cover ``0 .. n - 1``, one after another."""
    return ((a, min(a + STRETCH, n)) for a in range(0, n, STRETCH))


@dataclass
class Parts:
    """The regions of a block: anchor, first window and number of windows, and their hashes."""
    sent: np.ndarray
    offsets: np.ndarray
    more: object
    inside: np.ndarray  # for each symbol whether a window starts there
    prefix: np.ndarray
    anchor: np.ndarray
    start: np.ndarray
    count: np.ndarray

    def names(self, start: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
        """Names of regions, hashes that are even; those of single windows of hot anchors are odd."""
        return T.spanned(self.prefix, start, start + count + length - 1, T.STEP_INVERSE) & ~ONE

    def singles(self, wanted: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(windows whose names as single ones are known, their places in the sorted ``wanted``)."""
        likely = np.zeros(1 << 20, bool)
        likely[(wanted >> np.uint64(44)).astype(np.int64)] = True
        windows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in stretches(len(self.prefix) - length):
            names = T.spanned_all(self.prefix, length, T.STEP_INVERSE, a, b)
            near = np.flatnonzero(likely[(names >> np.uint64(44)).view(np.int64)] & self.inside[a:b])
            known, at = _find(names[near] | ONE, wanted)
            windows.append(near[known] + a)
            places.append(at)
        return np.concatenate(windows), np.concatenate(places)

    def documents(self, at: np.ndarray) -> np.ndarray:
        return T.owners(self.offsets, at)


def regions(table: pa.Table, rule: Rule) -> Parts:
    hashed, sent, offsets, more = rule.symbols(table)
    inside, prefix = T.within(offsets, rule.length), T.rolled(hashed, T.STEP)
    span = rule.length - rule.gram + 1
    starts, anchors = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a, b in stretches(len(hashed) - rule.length + 1):
        before = max(a - 1, 0)
        grams = T.spanned_all(prefix, rule.gram, T.STEP_INVERSE, before, b + span - 1)
        least = sliding_min(grams, span)
        first = inside[before:b].copy()
        # A window that begins with its anchor leaves it behind: an equal anchor of the next one is another place.
        first[1:] &= (least[1:] != least[:-1]) | (grams[:len(least) - 1] == least[:-1]) | ~inside[before:b - 1]
        heads = np.flatnonzero(first[a - before:]) + (a - before)
        starts.append(heads + before)
        anchors.append(least[heads])
    start = np.concatenate(starts)
    # A region ends where the next one begins, or with the last window of its document.
    last = offsets[1:][T.owners(offsets, start)] - rule.length + 1
    count = np.minimum(np.append(start[1:], len(hashed)), last) - start
    return Parts(sent, offsets, more, inside, prefix, T.mixed(np.concatenate(anchors)), start, count)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of known keys, their places in the sorted ``wanted``)."""
    if not len(wanted):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
    known = np.flatnonzero(wanted[at] == keys)
    return known, at[known]


def _located(parts: Parts, wanted: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first window, windows, place in the sorted ``wanted``, whether single) of all occurrences."""
    known, place = _find(parts.names(parts.start, parts.count, length), wanted)
    start, count, single = parts.start[known], parts.count[known], np.zeros(len(known), bool)
    hot = np.flatnonzero(wanted & ONE)
    if len(hot):
        alone, at = parts.singles(wanted[hot], length)
        start = np.append(start, alone)
        count = np.append(count, np.ones(len(alone), np.int64))
        place, single = np.append(place, hot[at]), np.append(single, np.ones(len(alone), bool))
    return start, count, place, single


def repeats(blocks: Blocks, rule: Rule, finish: Callable, schema: str) -> DataFrame:
    """``finish(rows, parts, repeated windows' starts)`` per block, as a table of the given schema."""
    n_shards, length = max(1, int(blocks.count * rule.shards_per_block)), rule.length

    def send_anchors(block: int, table: pa.Table) -> pa.Table:
        keys, counts = np.unique(regions(table, rule).anchor, return_counts=True)
        order, cuts = split_by(keys % np.uint64(n_shards))
        keys, counts = keys[order], counts[order].astype("<u4")
        return pa.table({"shard": pa.array([s for s, _ in cuts], pa.int32()), "block": pa.array([block] * len(cuts), pa.int32()),
                         "keys": pa.array([keys[c].tobytes() for _, c in cuts], pa.binary()),
                         "counts": pa.array([counts[c].tobytes() for _, c in cuts], pa.binary())})

    def keep_repeated(shard: int, mail: pa.Table) -> pa.Table:
        lists = unpacked(mail.column("keys"), "<u8")
        counts = joined(unpacked(mail.column("counts"), "<u4"), "<u4")
        _, place = np.unique(joined(lists, "<u8"), return_inverse=True)
        total = np.bincount(place, counts)[place]
        out, at = [], 0
        for keys, block in zip(lists, mail.column("block").to_pylist(), strict=True):
            mine = total[at:at + len(keys)]
            at += len(keys)
            if (mine > 1).any():
                out.append((block, keys[mine > 1].tobytes(), (mine[mine > 1] > HOT).tobytes()))
        return pa.table({"block": pa.array([o[0] for o in out], pa.int32()), "keys": pa.array([o[1] for o in out], pa.binary()),
                         "hot": pa.array([o[2] for o in out], pa.binary())})

    def send_regions(block: int, table: pa.Table, mail: pa.Table) -> pa.Table:
        parts = regions(table, rule)
        keys, hot = joined(unpacked(mail.column("keys"), "<u8"), "<u8"), joined(unpacked(mail.column("hot"), bool), bool)
        order = np.argsort(keys)
        known, at = _find(parts.anchor, keys[order])
        warm = hot[order][at]
        cold, many = known[~warm], known[warm]
        single = flat_ranges(parts.start[many], parts.count[many])
        start = np.concatenate([parts.start[cold], single])
        count = np.concatenate([parts.count[cold], np.ones(len(single), np.int64)])
        name = parts.names(start, count, length)
        name[len(cold):] |= ONE
        route = np.concatenate([parts.anchor[cold], name[len(cold):]])
        names, first, place = named(name)
        own = rule.summarise(place, parts.documents(start), table, len(names)).astype(rule.summary)
        order, cuts = split_by(route[first] % np.uint64(n_shards))
        names, own = names[order], own[order]
        return pa.table({"shard": pa.array([s for s, _ in cuts], pa.int32()), "block": pa.array([block] * len(cuts), pa.int32()),
                         "names": pa.array([names[c].tobytes() for _, c in cuts], pa.binary()),
                         "own": pa.array([own[c].tobytes() for _, c in cuts], pa.binary())})

    def ask_for_symbols(shard: int, mail: pa.Table) -> pa.Table:
        lists, own = unpacked(mail.column("names"), "<u8"), unpacked(mail.column("own"), rule.summary)
        senders = np.array(mail.column("block").to_pylist(), np.int64)
        order = np.argsort(senders, kind="stable")
        everyone = joined([lists[i] for i in order], "<u8")
        sender = np.repeat(senders[order], [len(lists[i]) for i in order])
        names, first, place = named(everyone)
        n_blocks = np.bincount(place, minlength=len(names))
        # A single window is all of its region: one without a copy cannot match anything, and there are many.
        summary = rule.combine(place, joined([own[i] for i in order], rule.summary), len(names))
        asked = ~(rule.lonely(summary, n_blocks) & ((names & ONE) > 0))
        names, first = names[asked], first[asked]
        order, cuts = split_by(sender[first])
        names = names[order]
        return pa.table({"block": pa.array([b for b, _ in cuts], pa.int32()), "shard": pa.array([shard] * len(cuts), pa.int32()),
                         "names": pa.array([names[c].tobytes() for _, c in cuts], pa.binary())})

    def send_symbols(block: int, table: pa.Table, mail: pa.Table) -> pa.Table:
        parts = regions(table, rule)
        lists = unpacked(mail.column("names"), "<u8")
        wanted = joined(lists, "<u8")
        target = np.repeat(np.array(mail.column("shard").to_pylist(), np.int64), [len(x) for x in lists])
        order = np.argsort(wanted)
        wanted, target = wanted[order], target[order]
        # A name stands for one content, so any occurrence will do.
        found, windows, place, _ = _located(parts, wanted, length)
        start, count = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        start[place], count[place] = found, windows
        order, cuts = split_by(target)
        start, sizes, wanted = start[order], count[order] + length - 1, wanted[order]
        out = []
        for shard, c in cuts:
            data = parts.sent[flat_ranges(start[c], sizes[c])]
            out.append((shard, wanted[c].tobytes(), sizes[c].astype("<u4").tobytes(), data.tobytes()))
        return pa.table({"shard": pa.array([o[0] for o in out], pa.int32()), "names": pa.array([o[1] for o in out], pa.binary()),
                         "sizes": pa.array([o[2] for o in out], pa.binary()), "data": pa.array([o[3] for o in out], pa.binary())})

    def decide(texts: pa.Table, mail: pa.Table) -> pa.Table:
        names, sizes = joined(unpacked(texts.column("names"), "<u8"), "<u8"), joined(
            unpacked(texts.column("sizes"), "<u4"), "<u4").astype(np.int64)
        data = joined(unpacked(texts.column("data"), rule.unit), rule.unit)
        lists, own = unpacked(mail.column("names"), "<u8"), unpacked(mail.column("own"), rule.summary)
        every, place = np.unique(joined(lists, "<u8"), return_inverse=True)
        summary = rule.combine(place, joined(own, rule.summary), len(every))
        at = np.searchsorted(every, names)
        count = np.ones(len(every), np.int64)
        count[at] = sizes - length + 1
        begins = np.cumsum(count) - count
        flags = np.zeros(int(count.sum()), bool)
        flags[flat_ranges(begins[at], count[at])] = rule.repeated(data, sizes, summary[at])
        out, at = [], 0
        for block, mine, sums in zip(mail.column("block").to_pylist(), lists, own, strict=True):
            here = place[at:at + len(mine)]
            at += len(mine)
            per = np.repeat(np.arange(len(here)), count[here])
            marked = rule.answer(flags[flat_ranges(begins[here], count[here])], summary[here][per], sums[per])
            tell = (np.bincount(per, marked, len(here)) > 0) | (rule.first_stays & ((mine & ONE) > 0))
            if tell.any():
                bits = np.packbits(marked[tell[per]])
                out.append((block, mine[tell].tobytes(), count[here][tell].astype("<u4").tobytes(), bits.tobytes()))
        return pa.table({"block": pa.array([o[0] for o in out], pa.int32()), "names": pa.array([o[1] for o in out], pa.binary()),
                         "counts": pa.array([o[2] for o in out], pa.binary()), "bits": pa.array([o[3] for o in out], pa.binary())})

    def mark(block: int, table: pa.Table, mail: pa.Table) -> pa.Table:
        parts = regions(table, rule)
        names, counts = unpacked(mail.column("names"), "<u8"), [
            c.astype(np.int64) for c in unpacked(mail.column("counts"), "<u4")]
        flags = joined([np.unpackbits(b)[:c.sum()] for b, c in zip(unpacked(mail.column("bits"), "u1"), counts, strict=True)],
                       "u1").astype(bool)
        names, counts = joined(names, "<u8"), joined(counts, np.int64)
        begins = np.cumsum(counts) - counts
        order = np.argsort(names)
        names, counts, begins = names[order], counts[order], begins[order]
        start, n, place, single = _located(parts, names, length)
        marked = np.zeros(len(parts.prefix), bool)
        window, flag = flat_ranges(start, n), flags[flat_ranges(begins[place], n)]
        marked[window[flag]] = True
        if rule.first_stays:
            # Copies within the block: only the smallest document's one is left to the shard's answer.
            for s, c in ((parts.start, parts.count), (start[single], n[single])):
                _, group = np.unique(parts.names(s, c, length), return_inverse=True)
                docs = parts.documents(s)
                own = rule.summarise(group, docs, table, int(group.max(initial=-1)) + 1)
                later = document_keys(table)[docs] > own[group]
                marked[flat_ranges(s[later], c[later])] = True
        return finish(block, table, parts, np.flatnonzero(marked))

    mail = "shard int, block int, "
    anchors = blocks.each(send_anchors, mail + "keys binary, counts binary")
    known = shards(anchors, keep_repeated, "block int, keys binary, hot binary", "repeated")
    sent = written(blocks.each_with(known, send_regions, mail + "names binary, own binary"), "regions")
    asked = shards(sent, ask_for_symbols, "block int, shard int, names binary", "asked")
    texts = blocks.each_with(asked, send_symbols, "shard int, names binary, sizes binary, data binary")
    told = texts.groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(
        decide, "block int, names binary, counts binary, bits binary")
    return blocks.each_with(written(told, "answers"), mark, schema)


def document_keys(table: pa.Table) -> np.ndarray:
    """Document ids for comparison; a null id is larger than all others."""
    ids = table.column("doc").combine_chunks() if isinstance(table.column("doc"), pa.ChunkedArray) else table.column("doc")
    return ids.fill_null(2**63 - 1).to_numpy(zero_copy_only=False)


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Symbols that lie in a window that starts at one of ``starts``, which ascend."""
    if not len(starts):
        return np.zeros(total, bool)
    # Windows that overlap or touch make one run.
    apart = np.flatnonzero(np.diff(starts) > length)
    begins, ends = starts[np.append(0, apart + 1)], starts[np.append(apart, len(starts) - 1)] + length
    cuts = np.column_stack([begins, ends]).ravel()
    return np.repeat(np.append(np.tile(np.array([False, True]), len(begins)), False), np.diff(cuts, prepend=0, append=total))
