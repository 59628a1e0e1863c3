"""WARC archives of pages, and their verified reading by pointer jumping over record boundaries.

Writing: one record per page, equal payloads stored once as a response and referred to by revisit records.
Spark's text writer makes the files, with the record end as line separator, so any store Spark writes will do.

Reading: archives are split at every occurrence of the magic, also at those inside payloads. Each piece is a
candidate record that points to its successor by its header's length. Files are cut into sections of a fixed number
of bytes (uncompressed), compressed ones too and whatever Spark's splits are. Within a section, chains are followed
in the task; across sections, entry points jump over their exits in log2(sections of a file) rounds, starting from the
start of each file. Only records that the chain reaches are real, pieces between two of them are payload.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.llm.blocks import released, written
from furlong.session import scratch_path

#: Parts of the public WARC 1.1 format.
MAGIC = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
HEX_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

MOST_SPLITS = 1_000_000
SECTION_BYTES = 4 << 20


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of a SHA-1: four digits for every five hexadecimal ones."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), HEX_DIGITS, BASE32_DIGITS)


def _encoded(text: Column) -> Column:
    """A header value: control characters and spaces are percent-encoded."""
    out = F.coalesce(text, F.lit(""))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(out, "\r", "%0D"), "\n", "%0A"), "[\\x00-\\x20\\x7f]", "%20")


def payload_groups(pages: DataFrame, key: str, payload: str, url: str, least: int) -> DataFrame:
    """Pages with payload, digest, size and the largest key among equal payloads of ``least`` bytes or more."""
    data = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("id"), _encoded(F.col(url).cast("string")).alias("url"),
                        data.alias("body"), F.octet_length(data).cast("long").alias("size"),
                        base32_sha1(data.cast("binary")).alias("digest"))
    last = rows.filter(F.col("size") >= least).groupBy(
        F.col("digest").alias("d2"), F.col("size").alias("size2")).agg(F.max("id").alias("keeper"))
    same = (F.col("digest") == F.col("d2")) & (F.col("size") == F.col("size2"))
    # Payloads move once at every size of the table; a hot one is split by the adaptive plan.
    return rows.join(last.hint("merge"), same, "left").drop("d2", "size2")


def write_archives(pages: DataFrame, path: str, key: str = "page_id", payload: str = "html", url: str = "url",
                   least: int = 0, compression: str = "gzip", records_per_file: int = 20_000) -> None:
    """Write one record per page as WARC files into the folder ``path``.

    A compressed file is read by one task, piece by piece, and so has a bounded number of records; ``none`` leaves files
    as they are, which are then read in splits.
    """
    rows = payload_groups(pages, key, payload, url, least)
    revisit = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(">"))
    kept = F.when(revisit, F.lit("")).otherwise(F.col("body"))
    head = F.concat_ws(
        "\r\n", F.concat(F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name), F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("keeper").cast("string"), F.lit(">"))),
        F.concat(F.lit("Content-Length: "), F.octet_length(kept).cast("string")))
    out = rows.select(F.concat(head, F.lit(RECORD_END), kept).alias("value"))
    with released(pages.sparkSession):
        out.write.option("lineSep", RECORD_END).option("compression", compression).option(
            "maxRecordsPerFile", records_per_file).text(path)


def _pieces(spark, path: str) -> DataFrame:
    """Pieces between magics with file, split and a number that gives their order.

    The number is the same in every read of the same archives, since splits are cut alike.
    """
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("no"), "value")


def _header(value: Column, name: str) -> Column:
    return F.regexp_extract(F.substring_index(value, RECORD_END, 1), f"(?m)^{name}: (.*?)\r?$", 1)


def candidates(spark, path: str) -> DataFrame:
    """A table ``file, block, at, next``: each piece, its offset and its successor's offset.

    ``at`` is where the piece's magic stands, before 0 for what precedes a file's first one; ``next`` is null
    if the piece has no usable header.
    """
    length = _header(F.col("value"), "Content-Length")
    found = _pieces(spark, path).select(
        "file", "block", "no", (F.octet_length("value") + len(MAGIC)).cast("long").alias("size"), length.alias("length"),
        F.when(F.contains("value", F.lit(RECORD_END)),
               F.octet_length(F.substring_index("value", RECORD_END, 1))).alias("head"))
    found = written(found.withColumn("length", F.expr("try_cast(length AS BIGINT)")), "pieces")
    inside = Window.partitionBy("file", "block").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    files = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = found.groupBy("file", "block").agg(F.sum("size").alias("sum")).select(
        "file", "block", F.coalesce(F.sum("sum").over(files), F.lit(0)).alias("start"))
    placed = found.withColumn("sum", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        starts, ["file", "block"]).withColumn("at", F.col("start") + F.col("sum") - len(MAGIC))
    after = F.col("at") + len(MAGIC) + F.col("head") + len(RECORD_END) + F.col("length") + len(RECORD_END)
    return placed.select("file", "block", "at", F.when((F.col("length") >= 0) & (F.col("at") >= 0), after).alias("next"))


def sectioned(links: DataFrame, section_bytes: int = SECTION_BYTES) -> DataFrame:
    """``file, section, at, next``: candidates with the section their offset lies in."""
    return links.select("file", F.floor(F.col("at") / section_bytes).cast("long").alias("section"), "at", "next")


def section_exits(links: DataFrame) -> DataFrame:
    """``file, section, at, out``: the first offset outside of its section to which each candidate's chain leads."""
    def leave(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at", ignore_index=True)
        at, to = frame["at"].to_numpy(), frame["next"].fillna(-1).to_numpy(np.int64)
        place = np.searchsorted(at, to)
        inner = (to > at) & (place < len(at)) & (at[np.minimum(place, len(at) - 1)] == to)
        out = to.copy()
        for i in range(len(at) - 1, -1, -1):
            if inner[i]:
                out[i] = out[place[i]]
        return pd.DataFrame({"file": frame["file"], "section": frame["section"], "at": at, "out": out})

    return links.groupBy("file", "section").applyInPandas(leave, "file string, section long, at long, out long")


def entry_nodes(exits: DataFrame) -> DataFrame:
    """``file, at, out`` of the nodes that are jumped: file starts and all that some chain enters from another section."""
    targets = exits.groupBy("file", F.col("out").alias("at")).agg(F.lit(True).alias("entered"))
    return exits.join(targets, ["file", "at"], "left").filter("entered OR at = 0").select("file", "at", "out")


def reached(nodes: DataFrame) -> DataFrame:
    """``file, at`` of the nodes that can be reached from their file's start, by pointer jumping.

    In every round a marked node marks the one its jump leads to, and all jumps double.
    """
    jumps = written(nodes, "jumps")
    marked = written(jumps.filter("at = 0").select("file", "at"), "marked")
    count = marked.count()
    while True:
        ahead = marked.join(jumps, ["file", "at"]).select("file", F.col("out").alias("at"))
        real = ahead.join(jumps.select("file", "at"), ["file", "at"], "left_semi")
        grown = written(marked.unionByName(real).distinct(), "marked")
        now = grown.count()
        if now == count:
            return marked
        marked, count = grown, now
        far = jumps.select("file", F.col("at").alias("out"), F.col("out").alias("far"))
        jumps = written(jumps.join(far, ["file", "out"], "left").select(
            "file", "at", F.coalesce("far", "out").alias("out")), "jumps")


def reachable(links: DataFrame, section_bytes: int = SECTION_BYTES) -> DataFrame:
    """``file, at`` of the records that the chain from offset 0 of their file reaches; ``links`` has ``file, at, next``."""
    links = written(sectioned(links, section_bytes), "links")
    marked = reached(entry_nodes(written(section_exits(links), "exits")))

    def follow(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at", ignore_index=True)
        at, to = frame["at"].to_numpy(), frame["next"].fillna(-1).to_numpy(np.int64)
        place = np.searchsorted(at, to)
        good = frame["entry"].to_numpy(bool).copy()
        for i in range(len(at)):
            if good[i] and at[i] < to[i] and place[i] < len(at) and at[place[i]] == to[i]:
                good[place[i]] = True
        return frame.loc[good, ["file", "at"]]

    entries = links.join(marked.withColumn("entry", F.lit(True)), ["file", "at"], "left").withColumn(
        "entry", F.coalesce("entry", F.lit(False)))
    return entries.groupBy("file", "section").applyInPandas(follow, "file string, at long")


def _assembled(rows: DataFrame) -> DataFrame:
    """``file, record, at, v, whole`` from pieces in the order of their splits.

    ``rows`` has ``file, block, value`` with the split's ``first`` offset, its first real record (``entry``) and
    the last one before it (``carried``). A record that lies in one split is put together here; what crosses a
    split's ends comes in parts.
    """
    magic, end = MAGIC.encode(), RECORD_END.encode()
    length_of = re.compile(rb"(?m)^Content-Length: (\d+)\r?$")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            out: list[tuple] = []
            for file, block, value, first, entry, carried in zip(*[batch.column(c).to_pylist() for c in (
                    "file", "block", "value", "first", "entry", "carried")], strict=True):
                if (file, block) != split:
                    if split and parts:
                        # It may go on in the next split, unless it ends with this one or with the file.
                        out.append((split[0], record, begun, magic.join(parts), record == begun and due in (at, at - len(magic))))
                    split, at, due, record, begun, parts = (file, block), first, entry, carried, None, []
                if at == due:
                    if parts:
                        out.append((file, record, begun, magic.join(parts), record == begun))
                    record, begun, parts = at, at, [value]
                    head = value.find(end)
                    size = length_of.search(value[:head]) if head >= 0 else None
                    due = at + len(magic) + head + 2 * len(end) + int(size[1]) if size else None
                elif record is not None:
                    begun = at if begun is None else begun
                    parts.append(value)
                at += len(value) + len(magic)
            if out:
                yield table(out)
        if split and parts:
            yield table([(split[0], record, begun, magic.join(parts), record == begun and due in (at, at - len(magic)))])

    def table(out: list) -> pa.RecordBatch:
        f, r, a, v, w = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(f), pa.array(r, pa.int64()), pa.array(a, pa.int64()),
                                           pa.array(v, pa.binary()), pa.array(w)], ["file", "record", "at", "v", "whole"])

    return rows.mapInArrow(run, "file string, record long, at long, v binary, whole boolean")


def read_archives(spark, path: str, section_bytes: int = SECTION_BYTES) -> DataFrame:
    """The real records below ``path``: ``file, at, type, record_id, refers_to, uri, digest, length, payload``.

    The magic may stand in payloads, also followed by a whole forged header. Empty files give no record, and
    neither does what follows a record without a usable length, nor a record that its file cuts off.
    """
    links = written(candidates(spark, path), "links")
    real = reachable(links.filter("at >= 0"), section_bytes).withColumn("real", F.lit(True))
    # Per split: where it begins, its first real record and the last one before it. A record goes on until the
    # next one begins, over as many splits as that takes.
    files = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    here = F.when(F.col("real"), F.col("at"))
    splits = links.select("file", "block", "at").join(real, ["file", "at"], "left").groupBy("file", "block").agg(
        F.min("at").alias("first"), F.min(here).alias("entry"), F.max(here).alias("last"))
    splits = written(splits.withColumn("carried", F.max("last").over(files)).drop("last"), "splits")
    texts = _pieces(spark, path).withColumn("value", F.col("value").cast("binary"))
    # A few numbers per split are sent along with the pieces, which then stay where they are read.
    if splits.count() <= MOST_SPLITS:
        texts = texts.join(F.broadcast(splits), ["file", "block"])
    else:
        texts = texts.join(splits, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "no")
    pieces = _assembled(texts)
    whole = pieces.filter("whole").select("file", F.col("record").alias("at"), F.col("v").cast("string").alias("v"))
    if not splits.groupBy("file").count().filter("count > 1").isEmpty():
        parts = F.array_sort(F.collect_list(F.struct("at", F.col("v").cast("string").alias("v"))))
        crossing = pieces.filter("not whole").groupBy("file", "record").agg(parts.alias("p")).select(
            "file", F.col("record").alias("at"), F.array_join(F.transform("p", lambda x: x["v"]), MAGIC).alias("v"))
        whole = whole.unionByName(crossing)
    length = _header(F.col("v"), "Content-Length").cast("long")
    data = F.expr(f"substring(cast(v AS binary), octet_length(substring_index(v, '\\r\\n\\r\\n', 1)) + {len(RECORD_END) + 1}, "
                  "cast(length AS int))")
    return whole.withColumn("length", length).select(
        "file", "at", _header(F.col("v"), "WARC-Type").alias("type"),
        _header(F.col("v"), "WARC-Record-ID").alias("record_id"),
        _header(F.col("v"), "WARC-Refers-To").alias("refers_to"), _header(F.col("v"), "WARC-Target-URI").alias("uri"),
        F.regexp_replace(_header(F.col("v"), "WARC-Payload-Digest"), "^sha1:", "").alias("digest"), "length",
        data.alias("payload")).filter(F.octet_length("payload") == F.col("length"))


def archived_pages(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url",
                   least: int = 0, path: str | None = None, compression: str = "gzip") -> DataFrame:
    """Write ``pages`` as archives, read them back: ``key, payload_bytes, payload_digest, record_type, refers_to``.

    Of equal payloads of ``least`` bytes or more, the pages with the largest key are responses and all others
    revisit it; smaller payloads are all responses. Null payloads are empty, a null url is an empty one. A
    null key is never the largest unless all are null, in which case all are responses. Repeated rows have a
    record each. Other columns are ignored. An empty table gives no rows. Sizes and digests of responses are
    taken from the payloads read; a revisit takes the size of the response it refers to.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, key, payload, url, least, compression)
    number = F.expr("try_cast(regexp_extract(record_id, '<urn:page:(.*)>', 1) AS BIGINT)")
    target = F.expr("try_cast(regexp_extract(refers_to, '<urn:page:(.*)>', 1) AS BIGINT)")
    read = read_archives(spark, path).select(
        number.alias("id"), "type", target.alias("target"), F.col("length").alias("size"),
        F.when(F.col("type") == "response", base32_sha1(F.col("payload"))).otherwise(F.col("digest")).alias("digest"))
    read = written(read, "records")
    sizes = read.filter("type = 'response'").groupBy(F.col("digest").alias("d2")).agg(F.max("size").alias("full"))
    revisits = read.filter("type = 'revisit'").join(sizes, F.col("digest") == F.col("d2"), "left")
    shape = lambda df, size, to: df.select(
        F.col("id").alias(key), size.cast("long").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), to.cast("long").alias("refers_to"))
    return shape(read.filter("type = 'response'"), F.col("size"), F.lit(None)).unionByName(
        shape(revisits, F.col("full"), F.col("target")))
