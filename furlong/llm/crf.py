"""Language of words and documents by a linear-chain conditional random field.

Words are the positions, languages the labels. A word's features are its hash, its prefixes and suffixes of
one to four bytes, its byte n-grams of two to four and whether a language's lexicon holds it; transitions
between neighbouring words are learned with them. Training sequences are spliced from stretches of documents
of several languages, so that the transitions are those of code-switched text. Forward-backward gives each
word's label probabilities; a document's language is the one with the highest mean over its words.

The model is fitted on a bounded sample; scoring streams all documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from furlong.llm import text as T
from furlong.llm.blocks import written

DOCS_PER_LANG = 400
MAX_BYTES = 20_000
BUCKETS = 1 << 18
GRAMS = (2, 3, 4)
AFFIXES = (1, 2, 3, 4)
CHUNK = 64
STRETCH = 128
PIECE_BYTES = 512 << 10
UNKNOWN = "und"
LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[128:] = True


def _flat(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for every n of ``counts``, one after another."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def word_features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature buckets, the word of each), words in order."""
    prefix, sizes = T.rolled(T.BYTE_VALUES[raw]), ends - starts
    who, what = [np.arange(len(starts))], [T.spanned(prefix, starts, ends)]
    for n in AFFIXES:
        has = np.flatnonzero(sizes > n)
        for salt, a, b in ((101, starts[has], starts[has] + n), (102, ends[has] - n, ends[has])):
            who.append(has)
            what.append(T.spanned(prefix, a, b) ^ T.U64(salt * 0x1000193))
    for n in GRAMS:
        count = np.maximum(sizes - n + 1, 0)
        at = np.repeat(starts, count) + _flat(count)
        who.append(np.repeat(np.arange(len(starts)), count))
        what.append(T.spanned(prefix, at, at + n) ^ T.U64(n * 0x811C9DC5))
    return (np.concatenate(what) & T.U64(BUCKETS - 1)).astype(np.int64), np.concatenate(who)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # buckets x languages
    transitions: np.ndarray  # from x to
    lexicon: np.ndarray  # sorted word hashes
    lexicon_langs: np.ndarray  # word x languages, 1 if the lexicon of the language holds the word
    lexicon_weights: np.ndarray  # languages x languages

    def emissions(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Label scores of words; words without a letter say nothing."""
        out = np.zeros((len(starts), len(self.langs)))
        if not len(starts):
            return out
        buckets, who = word_features(raw, starts, ends)
        for j in range(len(self.langs)):
            out[:, j] = np.bincount(who, self.weights[buckets, j], len(starts))
        out += self.lexical(T.word_hashes(raw, starts, ends)) @ self.lexicon_weights
        return out * has_letter(raw, starts, ends)[:, None]

    def lexical(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros((len(hashes), len(self.langs)))
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return self.lexicon_langs[at] * (self.lexicon[at] == hashes)[:, None]


def has_letter(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    seen = np.append(0, np.cumsum(LETTER[raw]))
    return seen[ends] > seen[starts]


def forward_backward(scores: np.ndarray, offsets: np.ndarray, transitions: np.ndarray,
                     pairs: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities of every position of many sequences at once.

    ``pairs``, if given, gets the expected number of each pair of neighbouring labels added to it.

    Sequences are cut into chunks. The product of a chunk's matrices carries messages across it, so long
    sequences take as many steps as they have chunks, and positions inside all chunks advance together.
    """
    n, k = scores.shape
    counts = np.diff(offsets)
    chunks = -(-counts // CHUNK)
    owner = np.repeat(np.arange(len(counts)), chunks)
    if not len(owner) or not k:
        return np.zeros((n, k))
    place = _flat(chunks)
    at = offsets[:-1][owner] + place * CHUNK
    length = np.minimum(offsets[1:][owner] - at, CHUNK)
    steps = int(length.max())
    grid = np.minimum(at[:, None] + np.arange(steps), n - 1)
    live = np.arange(steps) < length[:, None]
    emit = np.exp(scores - scores.max(1, keepdims=True))[grid]
    emit[~live] = 1.0
    move = np.exp(transitions - transitions.max())

    def normal(x: np.ndarray, axes) -> np.ndarray:
        return x / np.maximum(x.sum(axis=axes, keepdims=True), 1e-300)

    m = len(at)
    across = np.broadcast_to(np.eye(k), (m, k, k)).copy()  # entry label before the chunk -> label at its end
    begins = place == 0
    for t in range(steps):
        go = live[:, t]
        moved = across[go] @ move
        if t == 0:
            moved[begins[go]] = np.eye(k)  # no transition into a sequence's first word
        across[go] = normal(moved * emit[go, t][:, None, :], (1, 2))
    # Messages into each chunk, chunk by chunk for all sequences at once.
    into, back = np.full((m, k), 1.0 / k), np.full((m, k), 1.0 / k)
    order = np.argsort(place, kind="stable")
    bounds = np.searchsorted(place[order], np.arange(int(place.max()) + 2))
    for j in range(1, int(place.max()) + 1):
        here = order[bounds[j]:bounds[j + 1]]
        into[here] = normal(np.einsum("ij,ijk->ik", into[here - 1], across[here - 1]), 1)
    last = chunks - 1
    for j in range(int(last.max()) - 1, -1, -1):
        here = order[bounds[j]:bounds[j + 1]]
        here = here[last[owner[here]] > j]
        back[here] = normal(np.einsum("ijk,ik->ij", across[here + 1], back[here + 1]), 1)
    ahead = np.empty((m, steps, k))
    state = into
    for t in range(steps):
        moved = state @ move
        if t == 0:
            moved[begins] = state[begins]
        state = normal(moved * emit[:, t], 1)
        ahead[:, t] = state
    out = np.empty((n, k))
    state = back
    for t in range(steps - 1, -1, -1):
        here = live[:, t]
        out[grid[here, t]] = normal(ahead[here, t] * state[here], 1)
        if pairs is not None:
            joined = here if t else here & ~begins
            before = ahead[joined, t - 1] if t else into[joined]
            both = before[:, :, None] * move[None] * (emit[joined, t] * state[joined])[:, None, :]
            pairs += normal(both, (1, 2)).sum(0)
        state = np.where(here[:, None], normal((state * emit[:, t]) @ move.T, 1), state)
    return out


def _prepared(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw, offsets = T.buffer_of(texts)
    raw = T.LOWER[raw]
    return raw, *T.words_of(raw, offsets)


def fit(sample: Iterable[tuple[str, str]], seed: int = 7, epochs: int = 4, rate: float = 0.3) -> Model:
    """Fit on (text, language) pairs; an empty sample gives a model without languages."""
    rows = [(t, lang) for t, lang in sample if t]
    langs = sorted({lang for _, lang in rows})
    k = len(langs)
    raw, starts, ends, per = _prepared(pa.array([t for t, _ in rows], pa.large_string()))
    label = np.repeat([langs.index(lang) for _, lang in rows], np.diff(per)) if rows else np.zeros(0, np.int64)
    hashes = T.word_hashes(raw, starts, ends)
    known, inverse = np.unique(hashes, return_inverse=True)
    counts = np.zeros((len(known), k))
    np.add.at(counts, (inverse, label), 1)
    share = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    held = (counts >= 3) & (share >= 0.2)
    kept = held.any(1)
    model = Model(langs, np.zeros((BUCKETS, k)), np.zeros((k, k)), known[kept], held[kept].astype(float),
                  np.zeros((k, k)))
    if k < 2 or not len(starts):
        return model
    # Features of distinct words only.
    one = np.full(len(known), -1)
    one[inverse[::-1]] = np.arange(len(starts))[::-1]
    buckets, who = word_features(raw, starts[one], ends[one])
    order = np.argsort(who, kind="stable")
    buckets, who = buckets[order], who[order]
    cut = np.searchsorted(who, np.arange(len(known) + 1))
    lexical, letters = model.lexical(known), has_letter(raw, starts[one], ends[one])
    # Stretches of 1 to STRETCH words, spliced in random order into sequences of several languages.
    rng = np.random.default_rng(seed)
    bounds = [0]
    for i in range(len(per) - 1):
        while bounds[-1] < per[i + 1]:
            bounds.append(min(bounds[-1] + int(rng.integers(1, STRETCH)), int(per[i + 1])))
    bounds = np.unique(bounds)
    grown, grown_t, grown_l = np.full((BUCKETS, k), 1e-6), np.full((k, k), 1e-6), np.full((k, k), 1e-6)
    for _ in range(epochs):
        shuffled = rng.permutation(len(bounds) - 1)
        for batch in np.array_split(shuffled, max(1, len(shuffled) // 400)):
            size = bounds[batch + 1] - bounds[batch]
            at = np.repeat(bounds[batch], size) + _flat(size)
            ends_of = np.cumsum(size)[3::4]
            offsets = np.unique(np.concatenate([[0], ends_of, [len(at)]]))
            words, y = inverse[at], label[at]
            distinct, place = np.unique(words, return_inverse=True)
            width = cut[distinct + 1] - cut[distinct]
            feats = buckets[np.repeat(cut[distinct], width) + _flat(width)]
            feat_word = np.repeat(np.arange(len(distinct)), width)
            emit = np.stack([np.bincount(feat_word, model.weights[feats, j], len(distinct)) for j in range(k)], 1)
            emit = (emit + lexical[distinct] @ model.lexicon_weights) * letters[distinct][:, None]
            expected = np.zeros((k, k))
            p = forward_backward(emit[place], offsets, model.transitions, expected)
            error = -p
            error[np.arange(len(y)), y] += 1
            per_word = np.stack([np.bincount(place, error[:, j], len(distinct)) for j in range(k)], 1)
            per_word *= letters[distinct][:, None]
            used, slot = np.unique(feats, return_inverse=True)
            push = np.stack([np.bincount(slot, per_word[feat_word, j], len(used)) for j in range(k)], 1)
            push = push / len(at) - 1e-6 * model.weights[used]
            grown[used] += push**2
            model.weights[used] += rate * push / np.sqrt(grown[used])
            push = lexical[distinct].T @ per_word / len(at)
            grown_l += push**2
            model.lexicon_weights += rate * push / np.sqrt(grown_l)
            inner = np.ones(len(at), bool)
            inner[offsets[:-1]] = False
            t = np.flatnonzero(inner)
            seen = np.zeros((k, k))
            np.add.at(seen, (y[t - 1], y[t]), 1)
            push = (seen - expected) / max(1, len(t))
            grown_t += push**2
            model.transitions += 0.1 * rate * push / np.sqrt(grown_t)
    return model


def label_words(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label probabilities per word, weights, word offsets); words without a letter have weight 0."""
    raw, starts, ends, per = _prepared(texts)
    if not len(starts):
        return np.zeros((0, len(model.langs))), np.zeros(0), per
    _, one, inverse = np.unique(T.word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
    emit = model.emissions(raw, starts[one], ends[one])[inverse]
    return forward_backward(emit, per, model.transitions), has_letter(raw, starts, ends).astype(float), per


def training_sample(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang",
                    per_lang: int = DOCS_PER_LANG, max_bytes: int = MAX_BYTES, key: str = "doc_id") -> list[tuple]:
    """At most ``per_lang`` (text, language) pairs of each language, the first in the order of a hash.

    Only texts of at most ``max_bytes`` bytes are taken, so the sample's size is bounded; languages are few.
    """
    rows = docs.filter(learn & F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.octet_length(text) <= max_bytes))
    rows = rows.filter(F.col(text).rlike("\\p{L}"))
    rows = rows.select(F.col(lang).cast("string").alias("__lang"), F.col(text).cast("string").alias("__text"),
                       F.xxhash64(key).alias("__hash"))
    # Only about four times as many rows as wanted are moved, however many a language has. The counts are
    # written, so that Catalyst knows their size and sends them to the rows.
    counts = written(rows.groupBy(F.col("__lang").alias("__l")).agg(F.count("*").alias("__n")), "langs")
    share = F.pmod("__hash", F.lit(1 << 30)) / float(1 << 30)
    few = rows.join(counts, F.col("__lang") == F.col("__l")).filter(share * F.col("__n") <= 4 * per_lang)
    order = Window.partitionBy("__lang").orderBy("__hash", "__text")
    rows = few.withColumn("__at", F.row_number().over(order))
    picked = rows.filter(F.col("__at") <= per_lang).collect()
    return [(r["__text"], r["__lang"]) for r in sorted(picked, key=lambda r: (r["__lang"], r["__at"]))]


def with_language(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred",
                  score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its mean probability over the text's words (0 to 1).

    A text that is null or has no letter is ``und`` with score 0, and so is every text if the model knows no
    language. All columns and rows are kept; of two equal means the first language in order wins.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place, extra = docs.columns.index(text), len(docs.columns)

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for a, b in T.pieces(whole.column(place), PIECE_BYTES):
                part = whole.slice(a, b - a)
                p, weight, per = label_words(model, part.column(place).cast(pa.large_string()))
                lettered = np.array(part.column(extra).fill_null(False))
                if not model.langs:
                    best, top = np.zeros(b - a, np.int64), np.zeros(b - a)
                    lettered = np.zeros(b - a, bool)
                else:
                    who = T.owners(per, np.arange(len(p)))
                    mass = np.bincount(who, weight, b - a)
                    mean = np.stack([np.bincount(who, p[:, j] * weight, b - a) for j in range(p.shape[1])], 1)
                    mean /= np.maximum(mass, 1e-300)[:, None]
                    best = mean.argmax(1)
                    top = np.clip(mean[np.arange(b - a), best], 0.0, 1.0)
                names = [model.langs[i] if ok else UNKNOWN for i, ok in zip(best, lettered, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:extra], pa.array(names, pa.string()), pa.array(np.where(lettered, top, 0.0))],
                    names=[*part.schema.names[:extra], pred, score])

    out = docs.withColumn("__lettered", F.col(text).rlike("\\p{L}"))
    schema = StructType([*docs.schema.fields, StructField(pred, StringType()), StructField(score, DoubleType())])
    return out.mapInArrow(label, schema)
