"""Exchange clustering of all words that occur more than once, over a sharded table of neighbour classes.

Units (``brown.py``) give every word a class to begin with. In a round each block of texts adds up, per word,
how often each class stands after and before it, and sends the sums to the word's shard; the shards add them up
to a table of words and neighbour classes. The class bigrams are the sums of that table. Each word is then offered to
every class with all others where they are, and goes where the likelihood of the class bigrams gains most; words of even and
odd hashes take turns. Shards answer the blocks with the classes of their words.

Words that occur once or never in training go together as one word per ending and length, and take part as such.
What a block sends and a shard holds grows with the distinct words in it; the driver holds class bigrams alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm import text as T
from furlong.llm.blocks import Blocks, flat_ranges, joined, shards, split_by, unpacked

#: Training occurrences from which on a word is clustered by itself.
LEAST = 2
#: Numbers of words and classes that are worked on at a time.
CHUNK = 20_000
TABLE = ("names binary, classes binary, totals binary, sizes binary, codes binary, counts binary, "
         "blocks binary, lengths binary, places binary")
KINDS = {"names": "<u8", "classes": "u1", "totals": "<i8", "sizes": "<i4", "codes": "<u2", "counts": "<i8",
         "blocks": "<i4", "lengths": "<i4", "places": "<u4"}
ANSWER = "block int, names binary, classes binary, sums binary"


def ending_names(endings: int) -> np.ndarray:
    """Names of the words that stand for all rare words of an ending."""
    return T.mixed(np.arange(1, endings + 1, dtype=T.U64) * T.STEP)


def xlogx(x: np.ndarray) -> np.ndarray:
    """x log x of counts."""
    return x * np.log(np.maximum(x, 1))


def value(grid: np.ndarray) -> float:
    """Log likelihood of class bigrams, but for a constant."""
    return float(xlogx(grid).sum() - xlogx(grid.sum(0)).sum() - xlogx(grid.sum(1)).sum())


def neighbours(blocks: Blocks, mail: DataFrame, labelled, n: int) -> DataFrame:
    """The sharded table: a row per shard with its words, their classes, and what stands beside them.

    ``labelled(table, mail)`` gives a block's distinct names, their classes, the place of each token's name,
    whether the token is learned from, and the offsets of texts. Codes below ``n`` are classes after a word, then those before it, and ``2 n`` is the word itself.
    """
    codes = 2 * n + 1
    many = blocks.count

    def send(block: int, table: pa.Table, mail: pa.Table) -> pa.Table:
        names, classes, place, learn, per = labelled(table, mail)
        cls = classes[place]
        owner = T.owners(per, np.arange(len(place)))
        inner = np.flatnonzero((owner[1:] == owner[:-1]) & learn[1:])
        a, b = place[inner], place[inner + 1]
        same = a == b
        met = np.concatenate([a[~same] * codes + cls[inner + 1][~same], b[~same] * codes + n + cls[inner][~same],
                              a[same] * codes + 2 * n])
        met, times = np.unique(met, return_counts=True)
        order, cuts = split_by((T.mixed(names) % T.U64(many)).astype(np.int64))
        sizes = np.bincount(met // codes, minlength=len(names))
        starts = np.cumsum(sizes) - sizes
        moved = flat_ranges(starts[order], sizes[order])
        ends = np.concatenate([[0], np.cumsum(sizes[order])])
        columns = {"names": names[order], "classes": classes[order], "totals": np.bincount(place, learn, len(names))[order],
                   "sizes": sizes[order]}
        entries = {"codes": (met % codes)[moved], "counts": times[moved]}
        out: dict = {"shard": pa.array([s for s, _ in cuts], pa.int32()), "block": pa.array([block] * len(cuts), pa.int32())}
        for c, values in columns.items():
            out[c] = pa.array([values[x].astype(KINDS[c]).tobytes() for _, x in cuts], pa.binary())
        for c, values in entries.items():
            out[c] = pa.array([values[ends[x.start]:ends[x.stop]].astype(KINDS[c]).tobytes() for _, x in cuts], pa.binary())
        return pa.table(out)

    def add_up(shard: int, mail: pa.Table) -> pa.Table:
        got = {c: unpacked(mail.column(c), KINDS[c]) for c in ("names", "classes", "totals", "sizes", "codes", "counts")}
        whole = {c: joined(x, KINDS[c]) for c, x in got.items()}
        names, first, place = np.unique(whole["names"], return_index=True, return_inverse=True)
        met = np.repeat(place, whole["sizes"]) * codes + whole["codes"].astype(np.int64)
        met, to = np.unique(met, return_inverse=True)
        row = {"names": names, "classes": whole["classes"][first], "totals": np.bincount(place, whole["totals"], len(names)),
               "sizes": np.bincount(met // codes, minlength=len(names)), "codes": met % codes,
               "counts": np.bincount(to, whole["counts"], len(met)),
               "blocks": mail.column("block").to_numpy(), "lengths": np.array([len(x) for x in got["names"]]),
               "places": place}
        return pa.table({c: pa.array([np.asarray(row[c]).astype(k).tobytes()], pa.binary()) for c, k in KINDS.items()})

    schema = "shard int, block int, " + ", ".join(f"{c} binary" for c in ("names", "classes", "totals", "sizes", "codes", "counts"))
    return shards(blocks.each_with(mail.filter("block >= 0"), send, schema), add_up, TABLE, "neighbours")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: unpacked(batch.column(c).slice(i, 1), KINDS[c])[0] for c in batch.schema.names}


def grid_of(table: DataFrame, n: int) -> np.ndarray:
    """Counts of classes that follow one another."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = np.zeros((n, n))
        for row in _rows(batches):
            left = np.repeat(row["classes"], row["sizes"]).astype(np.int64)
            right = np.where(row["codes"] == 2 * n, left, row["codes"])
            use = (row["codes"] < n) | (row["codes"] == 2 * n)
            grid += np.bincount(left[use] * n + right[use], row["counts"][use], n * n).reshape(n, n)
        at = np.flatnonzero(grid)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(grid.ravel()[at])], ["at", "n"])

    rows = table.select("classes", "sizes", "codes", "counts").mapInArrow(count, "at long, n double")
    rows = rows.groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    grid = np.zeros(n * n)
    grid[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy()
    return grid.reshape(n, n)


def best_classes(classes: np.ndarray, sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray,
                 grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best class of each word with all others where they are, gain over its own); the last class takes none."""
    n, ends = len(grid), np.concatenate([[0], np.cumsum(sizes)])
    best, gain = classes.astype(np.int64), np.zeros(len(classes))
    at = 0
    while at < len(classes):
        upto = min(int(np.searchsorted(ends, ends[at] + CHUNK, side="right")) - 1, at + CHUNK // 8, len(classes))
        upto = max(upto, at + 1)
        x = slice(int(ends[at]), int(ends[upto]))
        gains = _gains(best[at:upto], sizes[at:upto], codes[x].astype(np.int64), counts[x].astype(float), grid)
        mine = gains[np.arange(upto - at), best[at:upto]]
        to = gains[:, :n - 1].argmax(1)
        gain[at:upto] = gains[np.arange(upto - at), to] - mine
        best[at:upto] = to
        at = upto
    return best, gain


def _gains(mine: np.ndarray, sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """What each class gains by each word, the word taken out of its own class before."""
    n, w = len(grid), len(mine)
    word = np.repeat(np.arange(w), sizes)
    dense = np.bincount(word * (2 * n + 1) + codes, counts, w * (2 * n + 1)).reshape(w, 2 * n + 1)
    follow, precede, itself = dense[:, :n], dense[:, n:2 * n], dense[:, 2 * n]
    every = np.arange(w)
    out = np.zeros((w, n))
    for part, other, table in ((codes < n, precede, grid.T), ((codes >= n) & (codes < 2 * n), follow, grid)):
        # A row per entry: the counts of all classes with the entry's class, without the word.
        logged = xlogx(table)
        who, beside, times = word[part], codes[part] % n, counts[part]
        rest = table[beside]
        own = beside == mine[who]
        rest[own] -= other[who[own]]
        rest[np.arange(len(who)), mine[who]] -= times
        rest[np.flatnonzero(own), mine[who[own]]] -= itself[who[own]]
        plain = logged[beside]
        plain[own] = xlogx(rest[own])
        plain[np.arange(len(who)), mine[who]] = xlogx(rest[np.arange(len(who)), mine[who]])
        change = xlogx(rest + times[:, None]) - plain
        if len(who):
            heads = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            out[who[heads]] += np.add.reduceat(change, heads, axis=0)
    diag = np.repeat(grid.diagonal()[None, :], w, 0)
    diag[every, mine] -= follow[every, mine] + precede[every, mine] + itself
    out += (xlogx(diag + follow + precede + itself[:, None]) - xlogx(diag + follow) - xlogx(diag + precede) + xlogx(diag))
    for sums, moved in ((grid.sum(1), follow.sum(1) + itself), (grid.sum(0), precede.sum(1) + itself)):
        rest = np.repeat(sums[None, :], w, 0)
        rest[every, mine] -= moved
        out -= xlogx(rest + moved[:, None]) - xlogx(rest)
    return out


def answers(table: DataFrame, grid: np.ndarray | None, step: int, endings: int, n: int) -> DataFrame:
    """Per block the classes of its words after a round; without a ``grid`` they stay as they are.

    Rows of block -1 hold the shard's ``sums``: per class its training tokens, then its distinct words without
    rare ones, then per ending the class of its rare words (-1: not in this shard). Not written yet.
    """
    sent = table.sparkSession.sparkContext.broadcast(grid)
    rare = ending_names(endings)

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = sent.value
        schema = pa.schema([("block", pa.int32()), ("names", pa.binary()), ("classes", pa.binary()), ("sums", pa.binary())])
        for row in _rows(batches):
            names, classes = row["names"], row["classes"].astype(np.int64)
            if grid is not None:
                turn = ((T.mixed(names ^ T.STEP) & T.U64(1)) == T.U64(step & 1)) & (classes != n - 1)
                offered = np.repeat(turn, row["sizes"])
                to, gain = best_classes(classes[turn], row["sizes"][turn], row["codes"][offered], row["counts"][offered], grid)
                classes[turn] = np.where(gain > 1e-6, to, classes[turn])
            place = np.minimum(np.searchsorted(names, rare), max(0, len(names) - 1))
            found = names[place] == rare
            common = row["totals"] > 0
            common[place[found]] = False
            sums = np.concatenate([np.bincount(classes, row["totals"], n), np.bincount(classes[common], minlength=n),
                                   np.where(found, classes[place], -1)]).astype("<i8")
            ends = np.concatenate([[0], np.cumsum(row["lengths"])])
            for i, block in enumerate(row["blocks"].tolist()):
                mine = row["places"][ends[i]:ends[i + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()), pa.array([names[mine].tobytes()], pa.binary()),
                     pa.array([classes[mine].astype("u1").tobytes()], pa.binary()), pa.array([None], pa.binary())], schema=schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int32()), pa.array([None], pa.binary()), pa.array([None], pa.binary()),
                 pa.array([sums.tobytes()], pa.binary())], schema=schema)

    return table.mapInArrow(tell, ANSWER)


def class_sums(told: DataFrame, rare_distinct: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(training tokens, distinct training words) per class, from the answers of all shards."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rare = np.zeros(2 * n, np.int64), np.full(len(rare_distinct), -1, np.int64)
        for batch in batches:
            for blob in batch.column("sums").to_pylist():
                values = np.frombuffer(blob, "<i8")
                total += values[:2 * n]
                rare = np.maximum(rare, values[2 * n:])
        known = np.flatnonzero(rare >= 0)
        np.add.at(total, n + rare[known], rare_distinct[known])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * n)), pa.array(total)], ["at", "value"])

    got = told.filter("block < 0").select("sums").mapInArrow(rows, "at long, value long")
    got = got.groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros(2 * n, np.int64)
    out[got["at"].to_numpy(np.int64)] = got["value"].to_numpy(np.int64)
    return out[:n], out[n:]
