"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of documents, each document a run of tokens. A queue is served in quanta; after ``x``
tokens of a source its clock stands at ``x / weight``, and the source whose next quantum ends first is served
next. This is deficit round-robin in closed form: what a source is owed is the distance of its clock, which is
carried on through all windows and partitions, and no stretch of the stream differs from the target shares by
more than a quantum per source. A source that runs dry leaves its share to the others.

The stream of quanta is cut into sequences. The place of a quantum comes from prefix sums over a range sort,
so neither a queue nor the stream passes through one task. The rest at the end is cut at powers of two, so
that no sequence needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.llm.text import pieces
from furlong.llm.tokens import encoder, ids_of
from furlong.operators.ordering import running_sums
from furlong.session import materialize, scratch_path

SEQUENCE = 1024
QUANTUM = 256
END_ID = 0


def encoded(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
            source: str = "source") -> DataFrame:
    """A written table ``rid, key, source, ids, n``: ids are 16-bit (32-bit for a larger vocabulary), 0 last.

    ``rid`` numbers the rows, so that repeated keys stay apart.
    """
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        kind = np.dtype("<u2" if tool.n_vocab <= 1 << 16 else "<u4")
        for whole in batches:
            for a, b in pieces(whole.column("t")):
                part = whole.slice(a, b - a)
                out = [np.array([*ids_of(tokenizer, t or ""), END_ID], kind) for t in part.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("k"), part.column("s"), pa.array([x.tobytes() for x in out], pa.binary()),
                     pa.array([len(x) for x in out], pa.int64()),
                     pa.array([kind.itemsize] * len(out), pa.int32())], ["k", "s", "ids", "n", "width"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(source).cast("string").alias("s"),
                       F.col(text).cast("string").alias("t"))
    rows = rows.mapInArrow(encode, "k long, s string, ids binary, n long, width int")
    path = scratch_path(docs.sparkSession, "ids")
    rows.withColumn("rid", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def queued(rows: DataFrame) -> DataFrame:
    """Add ``at``, the tokens before each row in its source's queue; queues are ordered by ``rid``.

    Sums run inside the pieces that one task wrote, pieces are added up in a table of sources and tasks.
    """
    rows = rows.select("rid", "s", "n").withColumn("part", F.shiftright("rid", 33))
    before = Window.partitionBy("s", "part").orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("s", "part").agg(F.sum("n").alias("sum")).select(
        F.col("s").alias("s2"), F.col("part").alias("part2"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"))
    inner = rows.withColumn("in", F.coalesce(F.sum("n").over(before), F.lit(0)))
    joined = inner.join(starts, F.col("s").eqNullSafe(F.col("s2")) & (F.col("part") == F.col("part2")))
    return joined.select("rid", "s", "n", (F.col("in") + F.col("start")).alias("at"))


def packed(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, quantum: int = QUANTUM,
           weights: Mapping[str | None, float] | None = None, key: str = "doc_id", text: str = "text",
           source: str = "source") -> DataFrame:
    """One row per piece: ``key, source, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``start`` counts the document's ids before the piece; ``ids_crc32`` is over the piece's ids as little-endian
    unsigned 32-bit numbers. ``weights`` are the target shares of sources; by default, and for sources it does
    not name, a source's share is its share of all tokens. Null or empty texts are the end id alone, a null
    source is a source like any other, repeated documents are packed each, null keys stay null, other columns
    are ignored. An empty table gives no pieces.
    """
    spark = docs.sparkSession
    ids = encoded(docs, tokenizer, key, text, source)
    rows = materialize(queued(ids), "queues")
    sums = rows.groupBy(F.col("s").alias("s2")).agg(F.sum("n").alias("all"))
    if weights:
        given = [(None if s is None else str(s), float(w)) for s, w in weights.items() if w > 0]
        table = F.broadcast(spark.createDataFrame(given, "s3 string, w double"))
        total = max(1, rows.agg(F.sum("n")).first()[0] or 0)
        sums = sums.join(table, F.col("s2").eqNullSafe(F.col("s3")), "left").select(
            "s2", F.coalesce("w", F.col("all") / total).alias("weight"))
    else:
        sums = sums.select("s2", F.col("all").cast("double").alias("weight"))
    # A document meets one or more quanta of its queue.
    q = F.lit(quantum).cast("long")
    met = rows.withColumn("quantum", F.explode(F.sequence(
        F.floor(F.col("at") / q), F.floor((F.col("at") + F.col("n") - 1) / q))))
    first = F.greatest(F.col("at"), F.col("quantum") * q)
    last = F.least(F.col("at") + F.col("n"), (F.col("quantum") + 1) * q)
    met = met.select("rid", "s", "quantum", (first - F.col("at")).alias("start"), (last - first).alias("length"))
    clocked = met.join(sums, F.col("s").eqNullSafe(F.col("s2"))).select(
        "rid", "s", "quantum", "start", "length", ((F.col("quantum") + 0.5) * quantum / F.col("weight")).alias("clock"))
    order = ["clock", "s", "quantum", "rid"]
    placed = running_sums(clocked, order, {"upto": "length"}).withColumn("place", F.col("upto") - F.col("length"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    # Sequences are full; the rest is cut at powers of two.
    full, rest = total // sequence, total % sequence
    cuts, at = [], full * sequence
    for bit in range(sequence.bit_length(), -1, -1):
        if rest & (1 << bit):
            cuts.append((at, at + (1 << bit)))
            at += 1 << bit
    spans = F.transform(F.sequence(F.floor(F.col("place") / sequence), F.floor((F.col("upto") - 1) / sequence)),
                        lambda i: F.struct(i.alias("no"), (i * sequence).alias("a"), ((i + 1) * sequence).alias("b")))
    spans = F.filter(spans, lambda x: x["no"] < full)
    if cuts:
        tail = F.array(*[F.struct(F.lit(full + i).cast("long").alias("no"), F.lit(a).cast("long").alias("a"),
                                  F.lit(b).cast("long").alias("b")) for i, (a, b) in enumerate(cuts)])
        tail = F.filter(tail, lambda x: (x["a"] < F.col("upto")) & (x["b"] > F.col("place")))
        spans = F.when(F.col("upto") > full * sequence, F.concat(spans, tail)).otherwise(spans)
    cut = placed.withColumn("span", F.explode(spans))
    a, b = F.greatest(F.col("place"), F.col("span.a")), F.least(F.col("upto"), F.col("span.b"))
    cut = cut.select("rid", F.struct(
        (F.col("start") + a - F.col("place")).alias("start"), (b - a).alias("length"),
        F.col("span.no").alias("sequence_id"), (a - F.col("span.a")).alias("offset")).alias("piece"))
    # Pieces that follow one another in a document and a sequence are one piece.
    per_doc = cut.groupBy("rid").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    joined = ids.select("rid", "k", "s", "ids", "n", "width").join(per_doc, "rid").select(
        "k", "s", "ids", "n", "width", "pieces")
    names = [key, source, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            owner = []
            for row, (blob, n, width, cuts_) in enumerate(zip(*[batch.column(c).to_pylist() for c in (
                    "ids", "n", "width", "pieces")], strict=True)):
                whole = np.frombuffer(blob, f"<u{width}").astype("<u4")
                for p in _joined(cuts_):
                    s, m = p["start"], p["length"]
                    for column, value in zip(out, (s, m, zlib.crc32(whole[s:s + m].tobytes()), n, p["sequence_id"],
                                                   p["offset"]), strict=True):
                        column.append(value)
                    owner.append(row)
            owners = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k").take(owners), batch.column("s").take(owners),
                 *[pa.array(c, pa.int64()) for c in out]], names)

    ddl = f"`{key}` long, `{source}` string, " + ", ".join(f"{c} long" for c in names[2:])
    return joined.mapInArrow(digest, ddl)


def _joined(cuts: list[dict]) -> Iterator[dict]:
    now = None
    for p in cuts:
        if now and now["sequence_id"] == p["sequence_id"] and now["offset"] + now["length"] == p["offset"]:
            now["length"] += p["length"]
        else:
            if now:
                yield now
            now = dict(p)
    if now:
        yield now
