"""Phrases whose words occur together more often than apart, mined with Rabin-Karp fingerprints.

Texts are split into pieces and words. Prefix polynomials give the fingerprint of any run of words at once. Blocks of
documents send their fingerprints with counts to the shards of the fingerprints' space; a shard adds up the counts of
all blocks and points back to the blocks that hold occurrences of a frequent one. First single words are counted, then
pairs of frequent words, then all longer runs of frequent pairs.

A second number, taken from the bytes of the words, goes beside each fingerprint. Where the numbers of all occurrences
agree, the one block that the shard points to as owner looks up the text of its occurrence and materialises the
phrase. Where they differ, fingerprints have collided: every block looks up the texts of all its occurrences, and the
counts are added up by the phrase itself. So a collision costs work, but does not change a count, unless both numbers
(64 bits and more) agree.

Only the bits of a fingerprint below those that name the shard are sent. There are about as many shards as blocks, so
the space grows with the corpus and four bytes do at any size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.llm import text as X
from furlong.llm.blocks import Blocks, flat_ranges, joined, shards, split_by, texts_of, unpacked, written

BLOCK_BYTES = 4 << 20
#: Bytes of texts that are hashed at once.
PART_BYTES = 1 << 20
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BETWEEN = BREAKS.copy()
BETWEEN[[0x20, 0x09]] = True
SEEN, PHRASE, COLLIDED, TOTAL = 0, 1, 2, 3
SCHEMA = ("kind int, block int, shard int, prints binary, checks binary, counts binary, lang string, words int, "
          "phrase string, n long")
REPLY = "block int, shard int, prints binary, checks binary, roles binary, totals binary"
#: What a frequent fingerprint is to a block.
HELD, OWNED, AMBIGUOUS = 0, 1, 2
MIXED = np.uint32(1 << 31)
ODD = X.U64(0xC2B2AE3D27D4EB4F)
#: Bits of a fingerprint that are sent; those above them say to which shard.
BITS = 32


class Words:
    """The words of a block: hashes, the piece and language each is in, and where its text stands."""

    def __init__(self, table: pa.Table, lang: str):
        texts, names = texts_of(table), table.column(lang).combine_chunks().dictionary_encode()
        names = names.chunk(0) if isinstance(names, pa.ChunkedArray) else names
        self.names = names.dictionary.to_pylist()
        codes = names.indices.to_numpy().astype(np.int64)
        raws, starts, ends, pieces, langs, hashes, at, piece = [], [], [], [], [], [], 0, 0
        for a, b in X.pieces(texts, PART_BYTES):
            raw, offsets = X.buffer_of(texts.slice(a, b - a))
            raw = X.LOWER[raw]
            s, e, per_doc = X.words_of(raw, offsets, BETWEEN)
            owner = X.owners(per_doc, np.arange(len(s)))
            inside = (np.cumsum(BREAKS[raw])[s] if len(s) else s) + owner
            pieces.append(inside + piece)
            langs.append(codes[a:b][owner])
            hashes.append(X.word_hashes(raw, s, e))
            raws.append(raw)
            starts.append(s + at)
            ends.append(e + at)
            at, piece = at + len(raw), piece + len(raw) + (b - a) + 1
        none = [np.zeros(0, np.int64)]
        self.raw = np.concatenate(raws or [np.zeros(0, np.uint8)])
        self.starts, self.ends, self.piece, self.lang = (np.concatenate(p or none) for p in (starts, ends, pieces, langs))
        self.hashes = np.concatenate(hashes or [np.zeros(0, X.U64)])
        label, offsets = X.buffer_of(pa.array(self.names, pa.string()))
        self.checks = self._checks()
        self.salts = X.mixed(X.word_hashes(label, offsets[:-1], offsets[1:]) + X.U64(1)) if len(self.names) else np.zeros(
            0, X.U64)

    def __len__(self) -> int:
        return len(self.starts)

    def _checks(self) -> np.ndarray:
        """A number per word from its length, its first and its last eight bytes."""
        padded = np.concatenate([np.zeros(8, np.uint8), self.raw, np.zeros(8, np.uint8)])
        out = (self.ends - self.starts).astype(np.uint64)
        if not len(out):
            return out
        eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
        short = (np.maximum(8 - (self.ends - self.starts), 0) * 8).astype(np.uint64)
        with np.errstate(over="ignore"):
            for at, cut in ((self.starts + 8, np.left_shift), (self.ends, np.right_shift)):
                eight = np.ascontiguousarray(eights[at]).view("<u8").ravel()
                # Bytes beside a short word are shifted out.
                out = X.mixed(out * ODD + cut(eight, short) + X.U64(1))
        return out

    def prints(self, n: int, shard_bits: int, bits: int) -> np.ndarray:
        """Fingerprints of the runs of n words at every position, also of those that leave their piece.

        The highest ``shard_bits`` bits are the shard, ``bits`` bits below them tell prints of a shard apart.
        """
        found = X.gram_hashes(self.hashes, n)
        with np.errstate(over="ignore"):
            found = found ^ (self.salts + X.U64(n) * ODD)[self.lang[:len(found)]]
        return X.mixed(found) >> X.U64(64 - shard_bits - bits)

    def checked(self, at: np.ndarray, n: int) -> np.ndarray:
        """The second numbers of the runs of n words at these positions."""
        with np.errstate(over="ignore"):
            out = self.salts[self.lang[at]] + X.U64(n)
            for j in range(n):
                out = out * ODD + self.checks[at + j]
        return (X.mixed(out) >> X.U64(32)).astype(np.uint32)

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words at a position lie in one piece."""
        return self.piece[n - 1:] == self.piece[:len(self) - n + 1] if len(self) >= n else np.zeros(0, bool)

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        """The n words at each position, joined by one space."""
        every = (at[:, None] + np.arange(n)).ravel()
        lengths = self.ends[every] - self.starts[every] + 1
        lengths[n - 1::n] -= 1
        source = np.minimum(flat_ranges(self.starts[every], lengths), max(len(self.raw) - 1, 0))
        out = self.raw[source]
        gaps = np.cumsum(lengths) - 1
        gaps = np.delete(gaps, np.arange(n - 1, len(gaps), n))
        out[gaps] = 0x20
        offsets = np.concatenate([[0], np.cumsum(lengths.reshape(-1, n).sum(1))])
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)).cast(
            pa.string())


def _rows(kind: int, block: int, size: int, **columns) -> pa.Table:
    kinds = {"kind": pa.int32(), "block": pa.int32(), "shard": pa.int32(), "prints": pa.binary(), "checks": pa.binary(),
             "counts": pa.binary(), "lang": pa.string(), "words": pa.int32(), "phrase": pa.string(), "n": pa.int64()}
    given = {"kind": np.full(size, kind, np.int32), "block": np.full(size, block, np.int32), **columns}
    return pa.table({c: pa.nulls(size, t) if c not in given else given[c] if isinstance(given[c], pa.Array)
                     else pa.array(given[c], t) for c, t in kinds.items()})


def _heads(ranked: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, np.int64)


def _messages(block: int, prints: np.ndarray, checks: np.ndarray, bits: int) -> pa.Table:
    """Distinct fingerprints with their second numbers and counts, one row per shard."""
    order = np.argsort(prints, kind="stable")
    prints, checks = prints[order], checks[order]
    heads = _heads(prints)
    counts = np.diff(np.append(heads, len(prints))).astype(np.uint32)
    if len(heads):
        counts[np.minimum.reduceat(checks, heads) != np.maximum.reduceat(checks, heads)] |= MIXED
    prints, checks = prints[heads], checks[heads]
    _, cuts = split_by((prints >> X.U64(bits)).astype(np.int64))
    low = (prints & X.U64((1 << bits) - 1)).astype("<u4")
    columns = {c: [x[cut].tobytes() for _, cut in cuts] for c, x in (("prints", low), ("checks", checks), ("counts", counts))}
    return _rows(SEEN, block, len(cuts), shard=[s for s, _ in cuts], **columns)


def _frequent(least: int):
    """What a shard returns to each block: those of its fingerprints that occur often enough in all blocks."""
    def answer(shard: int, mail: pa.Table) -> pa.Table:
        lists = unpacked(mail.column("prints"), "<u4")
        every = joined(lists, "<u4")
        checks, counts = (joined(unpacked(mail.column(c), "<u4"), "<u4") for c in ("checks", "counts"))
        order = np.argsort(every, kind="stable")
        heads = _heads(every[order])
        roles, totals = np.full(len(every), -1, np.int8), np.zeros(len(every), "<i8")
        if len(heads):
            sums = np.add.reduceat((counts & ~MIXED)[order].astype(np.int64), heads)
            mixed = np.maximum.reduceat(counts[order], heads) >= MIXED
            mixed |= np.minimum.reduceat(checks[order], heads) != np.maximum.reduceat(checks[order], heads)
            role = np.where(sums < least, -1, np.where(mixed, AMBIGUOUS, HELD)).astype(np.int8)
            roles[order] = np.repeat(role, np.diff(np.append(heads, len(every))))
            first = order[heads][role == HELD]
            roles[first], totals[first] = OWNED, sums[role == HELD]
        out: list[list] = [[], [], [], [], []]
        at = 0
        for prints, block in zip(lists, mail.column("block").to_pylist(), strict=True):
            here = slice(at, at + len(prints))
            at += len(prints)
            kept = roles[here] >= 0
            if kept.any():
                for column, value in zip(out, (block, *(x[kept].tobytes() for x in (
                        prints, checks[here], roles[here], totals[here]))), strict=True):
                    column.append(value)
        return pa.table({"block": pa.array(out[0], pa.int32()), "shard": pa.array([shard] * len(out[0]), pa.int32()),
                         **{c: pa.array(x, pa.binary()) for c, x in zip(("prints", "checks", "roles", "totals"), out[1:])}})
    return answer


def _materialised(words: Words, block: int, n: int, at: np.ndarray, name: np.ndarray, roles: np.ndarray,
                  totals: np.ndarray) -> list[pa.Table]:
    """The phrases of n words this block owns, and the counts of the ambiguous ones by their texts."""
    first = np.full(len(roles), -1, np.int64)
    first[name[::-1]] = at[::-1]
    own = np.flatnonzero((roles == OWNED) & (first >= 0))

    def texts(places: np.ndarray) -> dict:
        return {"lang": pa.array(words.names, pa.string()).take(pa.array(words.lang[places])),
                "phrase": words.phrases(places, n)}
    out = [_rows(PHRASE, block, len(own), words=np.full(len(own), n, np.int32), n=totals[own], **texts(first[own]))]
    unclear = at[roles[name] == AMBIGUOUS]
    if len(unclear):
        sums = pa.table(texts(unclear)).group_by(["lang", "phrase"]).aggregate([([], "count_all")])
        out.append(_rows(COLLIDED, block, sums.num_rows, words=np.full(sums.num_rows, n, np.int32),
                         n=sums.column("count_all").to_numpy(), lang=sums.column("lang").combine_chunks(),
                         phrase=sums.column("phrase").combine_chunks()))
    return out


def _step(lengths: Sequence[int], known: Sequence[int], shard_bits: int, bits: int):
    """What a block sends: fingerprints of runs of these lengths and the phrases of the lengths counted before.

    Before the first step nothing is known; a run must then consist of frequent runs of the greatest known length.
    """
    def send(block: int, rows: pa.Table, mail: pa.Table | None = None) -> pa.Table:
        if mail is not None and not mail.num_rows:
            return _rows(SEEN, block, 0)
        out, words, alive = [], Words(rows, "of"), None
        if mail is None:
            sizes = np.bincount(words.lang, minlength=len(words.names))
            out.append(_rows(TOTAL, block, len(sizes), lang=pa.array(words.names, pa.string()), n=sizes))
        else:
            lists = zip(mail.column("shard").to_pylist(), unpacked(mail.column("prints"), "<u4"), strict=True)
            wanted = np.concatenate([x.astype(np.uint64) | X.U64(s << bits) for s, x in lists])
            order = np.argsort(wanted)
            wanted = wanted[order]
            checks, roles, totals = (joined(unpacked(mail.column(c), t), t)[order] for c, t in (
                ("checks", "<u4"), ("roles", np.int8), ("totals", "<i8")))
            for n in known:
                at = np.flatnonzero(words.whole(n))
                prints = words.prints(n, shard_bits, bits)[at]
                name = np.minimum(np.searchsorted(wanted, prints), len(wanted) - 1)
                hit = np.flatnonzero(wanted[name] == prints)
                at, name = at[hit], name[hit]
                same = (roles[name] == AMBIGUOUS) | (checks[name] == words.checked(at, n))
                at, name = at[same], name[same]
                out += _materialised(words, block, n, at, name, roles, totals)
                alive = np.zeros(len(words), bool)
                alive[at] = True
        prints, checks = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for n in lengths:
            whole = words.whole(n)
            if alive is not None:
                for j in range(n - known[-1] + 1):
                    whole &= alive[j:j + len(whole)]
            at = np.flatnonzero(whole)
            prints.append(words.prints(n, shard_bits, bits)[at])
            checks.append(words.checked(at, n))
        out.append(_messages(block, np.concatenate(prints), np.concatenate(checks), bits))
        return pa.concat_tables(out)
    return send


def counted_phrases(docs: DataFrame, least: int = 100, most: int = 5, text: str = "text", lang: str = "lang",
                    block_bytes: int = BLOCK_BYTES, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(``lang, words, phrase, f`` of all phrases of 1 to ``most`` words that occur ``least`` times, ``lang, total``).

    ``bits`` (up to 32) narrows the fingerprints of a shard; fewer bits mean more collisions and more work, but the same result.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("of"), F.col(text).alias("text"))
    blocks = Blocks(rows, "text", ["of"], block_bytes)
    # As many shards as blocks, or up to twice that, so that a shard gets about what a block sends.
    shard_bits = (blocks.count - 1).bit_length()
    steps = [[1], [2], list(range(3, most + 1))] if most > 2 else [[n] for n in range(1, most + 1)]
    sent = written(blocks.each(_step(steps[0], [], shard_bits, bits), SCHEMA), "step")
    totals = sent.filter(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("n").alias("total"))
    found = None
    for known, lengths in zip(steps, [*steps[1:], []], strict=True):
        seen = sent.filter(F.col("kind") == SEEN).select("block", "shard", "prints", "checks", "counts")
        mail = shards(seen, _frequent(least), REPLY, "frequent")
        sent = written(blocks.each_with(mail, _step(lengths, known, shard_bits, bits), SCHEMA), "step")
        sure = sent.filter(F.col("kind") == PHRASE).select("lang", "words", "phrase", F.col("n").alias("f"))
        unclear = sent.filter(F.col("kind") == COLLIDED).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
        both = sure.unionByName(unclear.filter(F.col("f") >= least))
        found = both if found is None else found.unionByName(both)
    return written(found, "phrases"), written(totals, "totals")


def _run(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, least: int = 100, most: int = 5, top: int = 2000, text: str = "text",
                 lang: str = "lang", block_bytes: int = BLOCK_BYTES, bits: int = BITS) -> DataFrame:
    """The ``top`` best phrases of 2 to ``most`` words per language: ``lang, rank, phrase, a, l, r, n, score, cut``.

    Texts (A-Z lower-cased, null: empty) are split at ``.,;:!?`` and the characters 0x0A-0x0D into pieces and those at
    spaces and tabs into words; a null language is ``und``. ``n`` counts all words of the language, ``a`` the phrase,
    ``l`` and ``r`` the parts before and after a cut. The score is ``floor(1000 * a * n / (l * r))`` of the cut with
    the lowest one (``cut`` words before it, the fewest on a tie). Phrases below ``least`` occurrences are no
    candidates; one inside a longer candidate that occurs as often is dropped. Order: score and ``a`` descending,
    phrase ascending by bytes. Repeated rows count each, other columns are ignored, an empty table gives no rows. A
    text is worked on in one task, whatever its length.
    """
    counts, totals = counted_phrases(docs, least, most, text, lang, block_bytes, bits)
    words = F.split("phrase", " ")
    candidates = counts.filter("words >= 2").withColumn("w", words)
    inner = candidates.filter("words >= 3").select("lang", F.col("f").alias("longer"), F.explode(F.array_distinct(F.array(
        _run(F.col("w"), 1, F.col("words") - 1), _run(F.col("w"), 2, F.col("words") - 1)))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    own = candidates.join(inner, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < f").join(totals, "lang")
    cut = own.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), F.col("total").alias("n"), "cut",
        _run(F.col("w"), 1, F.col("cut")).alias("first"),
        _run(F.col("w"), F.col("cut") + 1, F.col("words") - F.col("cut")).alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    parts = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    # Whole numbers of up to 38 digits; a long holds the quotient.
    a, n, le, r = (F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r"))
    parts = parts.withColumns({"above": (a * n * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)"),
                               "below": (le * r).cast("decimal(38,0)")})
    scored = parts.withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = best.select("lang", "phrase", "a", "n", "m.*").withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score",
                         F.col("cut").cast("long").alias("cut"))
