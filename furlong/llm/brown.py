"""Brown class-based n-gram model: exchange clustering, class transitions and word emissions.

*Units* are where the exchange begins: the most frequent training words by themselves, every other word with those of
its ending and length, the end of a text alone. The counts of all pairs of neighbouring units over all training
texts are gathered. In each round every unit is offered to every class, with the others where they are; it goes where
the likelihood of the class bigrams gains most. Half of the units may move in a round, and a round that loses
likelihood is taken back. The end of a text keeps its class.

*Words* (``words.py``) take the class of their unit and go on by themselves: all that occur in training more than
once are exchanged over a sharded table of neighbour classes. Only rarer ones stay together by their endings.

*Model.* ``p(w | history) = p(class | history) * p(w | class)``. Class transitions are trigrams interpolated with
bigrams and unigrams by their number of observations (Witten-Bell), emissions are add-0.1 estimates over the
class's words and one unknown word.

Texts are dealt into blocks once; words are exchanged between blocks and shards of the word space, so a
block learns the counts and classes of its own words only and no vocabulary is ever in one place. The driver holds
counts of unit pairs per class, class trigrams and the units themselves, whose number is a parameter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm import text as T
from furlong.llm import words as W
from furlong.llm.blocks import Blocks, joined, shards, split_by, texts_of, unpacked, written

HEAD = 2048
ENDINGS = 254
CLASSES = 64
ROUNDS = 12
WORD_ROUNDS = 2
ADD = 0.1
EXCHANGE_TASKS = 16
_xlogx = W.xlogx
END_WORD = np.uint64(0x6A09E667F3BCC909)


def units_of(heads: np.ndarray, endings: int, words: np.ndarray, ending: np.ndarray) -> np.ndarray:
    """Unit of each word; the end of a text has the word ``END_WORD``."""
    out = len(heads) + ending
    if len(heads):
        at = np.minimum(np.searchsorted(heads, words), len(heads) - 1)
        out = np.where(heads[at] == words, at, out)
    return np.where(words == END_WORD, len(heads) + endings, out)


def tokens_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash of each token with an end after each text, its ending's bucket, offsets per text)."""
    raw, offsets = T.buffer_of(texts_of(table))
    raw = T.LOWER[raw]
    starts, ends, per = T.words_of(raw, offsets)
    words = T.word_hashes(raw, starts, ends)
    tail = T.spanned(T.rolled(T.BYTE_VALUES[raw]), np.maximum(starts, ends - 3), ends)
    ending = ((tail ^ T.U64(0x3C6EF372)) % T.U64(ENDINGS // 2)).astype(np.int64) * 2 + (ends - starts > 7)
    at = np.arange(len(words)) + T.owners(per, np.arange(len(words)))
    out, tails = np.full(len(words) + len(per) - 1, END_WORD), np.zeros(len(words) + len(per) - 1, np.int64)
    out[at], tails[at] = words, ending
    return out, tails, per + np.arange(len(per))


def _training(table: pa.Table) -> np.ndarray:
    return table.column("learn").to_numpy(zero_copy_only=False).astype(bool)


def _count_words(blocks: Blocks) -> tuple[DataFrame, DataFrame]:
    """(per block and shard the words and their training counts everywhere, the shards' totals and heads)."""
    n = blocks.count

    def send(block: int, table: pa.Table) -> pa.Table:
        words, endings, per = tokens_of(table)
        learn = np.repeat(_training(table), np.diff(per))
        names, first, place = np.unique(words, return_index=True, return_inverse=True)
        counts = np.bincount(place, learn, len(names)).astype("<u4")
        order, cuts = split_by(T.mixed(names) % T.U64(n))
        names, counts, tails = names[order], counts[order], endings[first][order].astype("u1")
        return pa.table({"shard": pa.array([s for s, _ in cuts], pa.int32()), "block": pa.array([block] * len(cuts), pa.int32()),
                         "names": pa.array([names[c].tobytes() for _, c in cuts], pa.binary()),
                         "counts": pa.array([counts[c].tobytes() for _, c in cuts], pa.binary()),
                         "tails": pa.array([tails[c].tobytes() for _, c in cuts], pa.binary())})

    def total(shard: int, mail: pa.Table) -> pa.Table:
        lists = unpacked(mail.column("names"), "<u8")
        names, first, place = np.unique(joined(lists, "<u8"), return_index=True, return_inverse=True)
        counts = np.bincount(place, joined(unpacked(mail.column("counts"), "<u4"), "<u4"), len(names)).astype(np.int64)
        tails = joined(unpacked(mail.column("tails"), "u1"), "u1")[first].astype(np.int64)
        known = (counts > 0) & (names != END_WORD)
        best = np.flatnonzero(known)
        best = best[np.lexsort((names[best], -counts[best]))][:HEAD]
        rare = known & (counts < W.LEAST)
        # Heads are not known yet: per ending, the sums over all of the shard's words.
        rows = {"block": [-1], "names": [names[best].tobytes()], "counts": [counts[best].astype("<i8").tobytes()],
                "tails": [tails[best].astype("u1").tobytes()],
                "sums": [np.concatenate([np.bincount(tails[known], counts[known], ENDINGS), np.bincount(tails[rare], minlength=ENDINGS),
                                         [known.sum(), counts[names == END_WORD].sum()]]).astype("<i8").tobytes()]}
        at = 0
        for mine, block in zip(lists, mail.column("block").to_pylist(), strict=True):
            rows["block"].append(block)
            rows["names"].append(mine.tobytes())
            rows["counts"].append(counts[place[at:at + len(mine)]].astype("<i8").tobytes())
            rows["tails"].append(None)
            rows["sums"].append(None)
            at += len(mine)
        return pa.table({"block": pa.array(rows["block"], pa.int32()), **{
            c: pa.array(rows[c], pa.binary()) for c in ("names", "counts", "tails", "sums")}})

    sent = blocks.each(send, "shard int, block int, names binary, counts binary, tails binary")
    told = shards(sent, total, "block int, names binary, counts binary, tails binary, sums binary", "counts")
    return told.filter("block >= 0").select("block", "names", "counts"), told.filter("block < 0")


def _heads(summary: DataFrame, head: int) -> tuple[np.ndarray, ...]:
    """(head words sorted, their counts, training tokens per ending without heads, distinct rare words per ending,
    distinct words, ends).

    Each shard gives its ``head`` first words as rows; the first ``head`` of all are taken by a top-k.
    """
    def rows(batches):
        for batch in batches:
            for names, counts, tails in zip(*[batch.column(c).to_pylist() for c in ("names", "counts", "tails")], strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(names, "<i8")), pa.array(np.frombuffer(counts, "<i8")),
                     pa.array(np.frombuffer(tails, "u1").astype(np.int64))], ["name", "count", "tail"])

    def sums(batches):
        for batch in batches:
            for blob in batch.column("sums").to_pylist():
                values = np.frombuffer(blob, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    best = summary.select("names", "counts", "tails").mapInArrow(rows, "name long, count long, tail long")
    best = best.orderBy(F.desc("count"), "name").limit(head).toPandas()
    totals = summary.select("sums").mapInArrow(sums, "at long, value long").groupBy("at").agg(
        F.sum("value").alias("value")).toPandas()
    values = np.zeros(2 * ENDINGS + 2, np.int64)
    values[totals["at"].to_numpy()] = totals["value"].to_numpy()
    names = best["name"].to_numpy(np.int64).view(np.uint64) if len(best) else np.zeros(0, np.uint64)
    order = np.argsort(names)
    counts, tails = best["count"].to_numpy(np.int64)[order], best["tail"].to_numpy(np.int64)[order]
    tokens = values[:ENDINGS].copy()
    np.subtract.at(tokens, tails, counts)
    return names[order], counts, tokens, values[ENDINGS:2 * ENDINGS], int(values[-2]), int(values[-1])


def _unit_pairs(blocks: Blocks, heads: np.ndarray) -> DataFrame:
    """``unit, after, before``: per unit the counts of the units after and before it, over all training texts.

    A block's counts are summed before they are sent; at most units x units numbers exist, whatever the size.
    """
    size = len(heads) + ENDINGS + 1
    sent = blocks.spark.sparkContext.broadcast(heads)

    def send(block: int, table: pa.Table) -> pa.Table:
        words, endings, per = tokens_of(table)
        units = units_of(sent.value, ENDINGS, words, endings)
        owner = T.owners(per, np.arange(len(units)))
        learn = _training(table)[owner]
        inner = np.flatnonzero((owner[1:] == owner[:-1]) & learn[1:])
        pairs, counts = np.unique(units[inner] * size + units[inner + 1], return_counts=True)
        return _packed(pairs, counts, size)

    def turn(batches):
        for batch in batches:
            for unit, others, counts in zip(*[batch.column(c).to_pylist() for c in ("unit", "others", "counts")], strict=True):
                pairs = np.frombuffer(others, "<u4").astype(np.int64) * size + unit
                out = _packed(pairs, np.frombuffer(counts, "<i8"), size)
                yield pa.RecordBatch.from_arrays([c.combine_chunks() for c in out.columns], out.schema.names)

    def add_up(shard: int, mail: pa.Table) -> pa.Table:
        pairs, place = np.unique(joined(unpacked(mail.column("pairs"), "<i8"), "<i8"), return_inverse=True)
        counts = np.bincount(place, joined(unpacked(mail.column("counts"), "<i8"), "<i8"), len(pairs)).astype("<i8")
        order, cuts = split_by(pairs // size)
        return pa.table({"unit": pa.array([u for u, _ in cuts], pa.int32()),
                         "others": pa.array([(pairs[order][c] % size).astype("<u4").tobytes() for _, c in cuts], pa.binary()),
                         "counts": pa.array([counts[order][c].tobytes() for _, c in cuts], pa.binary())})

    mail, units = "shard int, pairs binary, counts binary", "unit int, others binary, counts binary"
    after = shards(blocks.each(send, mail), add_up, units, "after")
    before = shards(after.mapInArrow(turn, mail), add_up, units, "before")
    after = after.select("unit", F.col("others").alias("after"), F.col("counts").alias("n_after"))
    before = before.select("unit", F.col("others").alias("before"), F.col("counts").alias("n_before"))
    return written(after.join(before, "unit", "full").repartition("unit"), "neighbours")


def _packed(pairs: np.ndarray, counts: np.ndarray, size: int, groups: int = 64) -> pa.Table:
    """Messages of unit pairs with counts to the shards of their first unit."""
    order, cuts = split_by((pairs // size) % groups)
    pairs, counts = pairs[order].astype("<i8"), counts[order].astype("<i8")
    return pa.table({"shard": pa.array([s for s, _ in cuts], pa.int32()),
                     "pairs": pa.array([pairs[c].tobytes() for _, c in cuts], pa.binary()),
                     "counts": pa.array([counts[c].tobytes() for _, c in cuts], pa.binary())})


def _best_classes(rows: list[tuple], classes: np.ndarray, n: int, grid: np.ndarray) -> list[tuple[int, int, float]]:
    """(unit, best class, gain) with all other units where they are."""
    out = []
    left, right = grid.sum(1), grid.sum(0)
    for unit, after, n_after, before, n_before in rows:
        mine = int(classes[unit])
        follow, precede, self_count = np.zeros(n), np.zeros(n), 0.0
        if after is not None:
            others, counts = np.frombuffer(after, "<u4"), np.frombuffer(n_after, "<i8").astype(float)
            self_count = float(counts[others == unit].sum())
            follow = np.bincount(classes[others[others != unit]], counts[others != unit], n)
        if before is not None:
            others, counts = np.frombuffer(before, "<u4"), np.frombuffer(n_before, "<i8").astype(float)
            precede = np.bincount(classes[others[others != unit]], counts[others != unit], n)
        # Without the unit.
        rest = grid.copy()
        rest[mine] -= follow
        rest[:, mine] -= precede
        rest[mine, mine] -= self_count
        out_l, in_l = follow.sum() + self_count, precede.sum() + self_count
        l, r = left.copy(), right.copy()
        l[mine] -= out_l
        r[mine] -= in_l
        # Gain of class c: its row and column change, and so do their sums.
        row = (_xlogx(rest + follow[None, :]) - _xlogx(rest)).sum(1)
        col = (_xlogx(rest + precede[:, None]) - _xlogx(rest)).sum(0)
        diag = rest.diagonal()
        cross = (_xlogx(diag + follow + precede + self_count) - _xlogx(diag + follow) - _xlogx(diag + precede) + _xlogx(diag))
        gain = row + col + cross - (_xlogx(l + out_l) - _xlogx(l)) - (_xlogx(r + in_l) - _xlogx(r))
        best = int(gain[:-1].argmax())  # the last class belongs to the end of a text
        out.append((int(unit), best, float(gain[best] - gain[mine])))
    return out


def exchange(neighbours: DataFrame, sizes: np.ndarray, n_classes: int, rounds: int) -> np.ndarray:
    """The class of each unit; the last unit, the end of a text, has the last class to itself."""
    # At most units x units numbers, whatever the corpus: a few tasks do for a round.
    neighbours = neighbours.coalesce(EXCHANGE_TASKS)
    n, order = len(sizes), np.argsort(-sizes[:-1], kind="stable")
    classes = np.full(n, n_classes - 1)
    classes[order] = np.arange(n - 1) % (n_classes - 1)

    def grid_of(classes: np.ndarray) -> np.ndarray:
        def count(batches):
            grid = np.zeros((n_classes, n_classes))
            for batch in batches:
                for unit, after, counts in zip(*[batch.column(c).to_pylist() for c in ("unit", "after", "n_after")], strict=True):
                    if after is not None:
                        grid[classes[unit]] += np.bincount(classes[np.frombuffer(after, "<u4")],
                                                           np.frombuffer(counts, "<i8").astype(float), n_classes)
            at = np.flatnonzero(grid)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(grid.ravel()[at])], ["at", "n"])

        rows = neighbours.select("unit", "after", "n_after").mapInArrow(count, "at long, n double").groupBy("at").agg(
            F.sum("n").alias("n")).toPandas()
        grid = np.zeros(n_classes * n_classes)
        grid[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy()
        return grid.reshape(n_classes, n_classes)

    grid = grid_of(classes)
    best = W.value(grid)
    for step in range(rounds):
        def offer(batches, classes=classes, grid=grid):
            for batch in batches:
                rows = [r for r in zip(*[batch.column(c).to_pylist() for c in (
                    "unit", "after", "n_after", "before", "n_before")], strict=True) if r[0] != n - 1]
                found = [f for f in _best_classes(rows, classes, n_classes, grid) if f[2] > 1e-6]
                if found:
                    u, c, g = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(c, pa.int64()), pa.array(g)], ["unit", "to", "gain"])

        moves = neighbours.mapInArrow(offer, "unit long, to long, gain double").toPandas()
        if not len(moves):
            break
        units, to = moves["unit"].to_numpy(), moves["to"].to_numpy()
        turn = (T.mixed(units.astype(np.uint64) * T.BASE + T.U64(step)) & T.U64(1)).astype(bool)
        new = classes.copy()
        new[units[turn]] = to[turn]
        grown = grid_of(new)
        if W.value(grown) <= best:
            # Too many moves at once: the quarter with the highest gains.
            top = moves.sort_values(["gain", "unit"], ascending=[False, True]).head(max(1, len(moves) // 4))
            new = classes.copy()
            new[top["unit"].to_numpy()] = top["to"].to_numpy()
            grown = grid_of(new)
            if W.value(grown) <= best:
                continue
        classes, grid, best = new, grown, W.value(grown)
    return classes


def _labels(table: pa.Table, mail: pa.Table) -> tuple[np.ndarray, ...]:
    """(names, their classes, place of each token's name, whether it is learned from, offsets of texts).

    Names and classes are the shards' answers; a word without one is rare and has the name of its ending.
    """
    return _labelled(tokens_of(table), table, mail)


def _labelled(tokens: tuple[np.ndarray, ...], table: pa.Table, mail: pa.Table) -> tuple[np.ndarray, ...]:
    words, endings, per = tokens
    mail = mail.filter(pa.compute.is_valid(mail.column("classes")))
    names, classes = joined(unpacked(mail.column("names"), "<u8"), "<u8"), joined(unpacked(mail.column("classes"), "u1"), "u1")
    order = np.argsort(names)
    names, classes = names[order], classes[order].astype(np.int64)
    place = np.minimum(np.searchsorted(names, words), len(names) - 1)
    rare = np.flatnonzero(names[place] != words)
    place[rare] = np.searchsorted(names, W.ending_names(ENDINGS))[endings[rare]]
    return names, classes, place, _training(table)[T.owners(per, np.arange(len(words)))], per


def _first_labels(heads: np.ndarray, classes: np.ndarray):
    """Like :func:`_labels`, by the counts of words and the classes of units."""
    def labels(table: pa.Table, mail: pa.Table) -> tuple[np.ndarray, ...]:
        words, endings, per = tokens_of(table)
        names, counts = joined(unpacked(mail.column("names"), "<u8"), "<u8"), joined(unpacked(mail.column("counts"), "<i8"), "<i8")
        order = np.argsort(names)
        common = counts[order][np.searchsorted(names[order], words)] >= W.LEAST
        named = np.where(common | (words == END_WORD), words, W.ending_names(ENDINGS)[endings])
        # A word of its own begins in its unit's class, rare words of an ending in that ending's.
        units = np.where(named == words, units_of(heads, ENDINGS, words, endings), len(heads) + endings)
        names, first, place = np.unique(named, return_index=True, return_inverse=True)
        return names, classes[units[first]], place, _training(table)[T.owners(per, np.arange(len(words)))], per
    return labels


def word_classes(blocks: Blocks, counts: DataFrame, heads: np.ndarray, classes: np.ndarray, n: int,
                 rounds: int) -> tuple[DataFrame, np.ndarray]:
    """(the shards' answers with the class of each block's words, counts of three classes in a row).

    A round after which the likelihood of the class bigrams is lower is taken back and the last.
    """
    def unchanged(table: DataFrame) -> DataFrame:
        return written(W.answers(table, None, 0, ENDINGS, n), "classes")

    labelled, mail, kept_table, best = _first_labels(heads, classes), counts, None, -math.inf
    for step in range(max(1, rounds)):
        table = W.neighbours(blocks, mail, labelled, n)
        grid = W.grid_of(table, n)
        if kept_table is not None and W.value(grid) < best:
            mail = unchanged(kept_table)
            return mail, _class_trigrams(blocks, mail, n)
        kept_table, best, labelled = table, W.value(grid), _labels
        mail = written(W.answers(table, grid if rounds else None, step, ENDINGS, n), "classes")
    trigrams = _class_trigrams(blocks, mail, n)
    if W.value(trigrams[:, :n, :n].sum(0).astype(float)) < best:
        mail = unchanged(kept_table)
        trigrams = _class_trigrams(blocks, mail, n)
    return mail, trigrams


def _class_trigrams(blocks: Blocks, mail: DataFrame, n: int) -> np.ndarray:
    """Counts of three classes in a row over all training texts; class ``n`` stands before the first token."""
    side = n + 1

    def count(block: int, table: pa.Table, mail: pa.Table) -> pa.Table:
        _, classes, place, learn, per = _labels(table, mail)
        c = classes[place]
        at, counts = np.unique((_histories(c, per, n) * side + c)[learn], return_counts=True)
        return pa.table({"at": pa.array(at.astype(np.int64)), "n": pa.array(counts.astype(np.int64))})

    rows = blocks.each_with(mail.filter("block >= 0"), count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(side**3, np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out.reshape(side, side, side)


def _histories(c: np.ndarray, per: np.ndarray, n: int) -> np.ndarray:
    """Code of the two classes before each token."""
    one, two = np.full(len(c), n), np.full(len(c), n)
    one[1:], two[2:] = c[:-1], c[:-2]
    starts = per[:-1]
    starts = starts[starts < len(c)]
    one[starts], two[starts] = n, n
    second = starts + 1
    second = second[second < len(c)]
    two[second] = n
    return two.astype(np.int64) * (n + 1) + one


def transitions(counts: np.ndarray) -> np.ndarray:
    """log10 p(class | two before), interpolated by Witten-Bell; the start is never predicted."""
    n = counts.shape[0] - 1
    tri = counts[:, :, :n].astype(float)
    bi, uni = tri.sum(0), tri.sum((0, 1))
    base = (uni + ADD) / (uni.sum() + ADD * n)

    def mixed(c: np.ndarray, lower: np.ndarray) -> np.ndarray:
        kinds = (c > 0).sum(-1, keepdims=True)
        total = c.sum(-1, keepdims=True)
        return np.where(total > 0, (c + kinds * lower) / np.maximum(total + kinds, 1), lower)

    return np.log10(mixed(tri, mixed(bi, base[None, :])[None, :, :]))


def scored(docs: DataFrame, learn: str, key: str = "doc_id", text: str = "text", head: int = HEAD,
           n_classes: int = CLASSES, rounds: int = ROUNDS, word_rounds: int = WORD_ROUNDS) -> DataFrame:
    """One row per document: ``key, learn, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words (runs without space and 0x09-0x0D, A-Z lower-cased) and one end per text. The model
    learns from the documents whose boolean column ``learn`` is true; null counts as false. ``score`` is its
    log10 probability of a text, ``base_score`` that of add-0.1 unigrams over the same training tokens,
    ``n_known`` the tokens that occur in them. There are ``rounds`` of exchange of units and ``word_rounds`` of words;
    ``n_classes`` is 255 at most. A null text is empty and has the end alone. Without training
    documents every token is unknown. Repeated rows are scored and learned each, null keys stay null, other
    columns are ignored; an empty table gives no rows.
    """
    if not 2 <= n_classes <= 255:
        raise ValueError("n_classes must be between 2 and 255")
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(learn), F.lit(False)).alias("learn"),
                       F.col(text).alias("__text"))
    blocks = Blocks(rows, "__text", ["doc", "learn"])
    counts, summary = _count_words(blocks)
    heads, head_counts, tail_tokens, rare_distinct, distinct, ends = _heads(summary, head)
    sizes = np.concatenate([head_counts, tail_tokens, [ends]])
    total, kinds = int(sizes.sum()), distinct + (1 if ends else 0)
    units = exchange(_unit_pairs(blocks, heads), sizes, n_classes, rounds)
    told, trigrams = word_classes(blocks, counts, heads, units, n_classes, word_rounds)
    tokens, words = W.class_sums(told, rare_distinct, n_classes)
    emit_log, transition = np.log10(tokens + ADD * (words + 1)), transitions(trigrams)
    sent = blocks.spark.sparkContext.broadcast((emit_log, transition))
    mail = told.filter("block >= 0").select("block", "names", "classes", F.lit(None).cast("binary").alias("counts"))
    mail = mail.unionByName(counts, allowMissingColumns=True)

    def score(block: int, table: pa.Table, mail: pa.Table) -> pa.Table:
        emit_log, transition = sent.value
        tokens = tokens_of(table)
        _, classes, place, _, per = _labelled(tokens, table, mail)
        c = classes[place]
        mail = mail.filter(pa.compute.is_valid(mail.column("counts")))
        names = joined(unpacked(mail.column("names"), "<u8"), "<u8")
        counts = joined(unpacked(mail.column("counts"), "<i8"), "<i8")
        order = np.argsort(names)
        count = counts[order][np.searchsorted(names[order], tokens[0])]
        step = transition.reshape(-1, n_classes)[_histories(c, per, n_classes), c]
        emit = np.log10(count + ADD) - emit_log[c]
        base = np.log10(count + ADD) - math.log10(total + ADD * (kinds + 1))
        owner, docs = T.owners(per, np.arange(len(c))), table.num_rows
        return pa.table({
            "doc": table.column("doc"), "learn": table.column("learn"), "n_tokens": pa.array(np.diff(per)),
            "n_known": pa.array(np.bincount(owner, count > 0, docs).astype(np.int64)),
            "train_tokens": pa.array(np.full(docs, total, np.int64)),
            "base_score": pa.array(np.bincount(owner, base, docs)),
            "score": pa.array(np.bincount(owner, step + emit, docs))})

    schema = "doc long, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.each_with(mail, score, schema).withColumnsRenamed({"doc": key, "learn": learn})
