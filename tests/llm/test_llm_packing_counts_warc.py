"""Packing, token counts and archives: exact round trips and brute force."""

import base64
import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from furlong.llm import counts, packing, warc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tool():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def texts():
    rng = np.random.default_rng(2)
    out = [(i, f"s{int(rng.integers(0, 3))}", " ".join(f"wörd{x}\n" for x in rng.integers(0, 900, int(rng.integers(0, 700)))))
           for i in range(60)]
    out += [(100, "s0", None), (101, None, "x y"), (102, "s1", ""), (3, "s0", out[3][2]), (None, "s2", "<|endoftext|> a"),
            (104, "s2", "a" * 30_000), (105, "s2", "日本語\n\n\n  テキスト 🎉 " * 50)]
    return out


def check_packing(tool, rows, pieces, sequence):
    want = defaultdict(list)
    for i, _, t in rows:
        want[i].append([*(tool.encode(t or "", add_special_tokens=False).ids), 0])
    got, filled = defaultdict(list), defaultdict(list)
    for p in pieces:
        got[p["doc_id"]].append(p)
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, docs in want.items():
        crcs = {(p["start"], p["length"], p["ids_crc32"]) for p in got[i]}
        assert sum(p["length"] for p in got[i]) == sum(map(len, docs))
        for start, length, crc in crcs:
            assert any(zlib.crc32(np.array(d[start:start + length], "<u4").tobytes()) == crc for d in docs)
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at == sequence or (at < sequence and at & (at - 1) == 0)
    return filled


def test_packing_keeps_every_id_once_without_padding(spark, tool):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("rid", F.lit(1)).repartition(4)
    check_packing(tool, rows, packing.packed(df, RANKS, sequence=256, quantum=64).collect(), 256)


def test_packing_follows_the_target_shares(spark, tool):
    rows = [(i, "a" if i % 4 == 0 else "b", "word " * 200) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    for weights, share in ((None, 0.25), ({"a": 1.0, "b": 1.0}, 0.5)):
        pieces = packing.packed(df, RANKS, sequence=512, quantum=64, weights=weights).collect()
        check_packing(tool, rows, pieces, 512)
        seen = defaultdict(int)
        total_a = sum(p["length"] for p in pieces if p["source"] == "a")
        done = 0
        for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
            if seen["a"] < total_a - 64 and done:
                assert abs(seen["a"] - share * done) <= 3 * 64
            seen[p["source"]] += p["length"]
            done += p["length"]


def test_packing_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert packing.packed(df, RANKS).count() == 0


def test_sections_add_up_and_follow_the_rule(spark, tool):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("k", F.lit(1)).repartition(3)
    got = defaultdict(list)
    for r in counts.section_tokens(df, RANKS).collect():
        got[r["doc_id"]].append(r)
    for i, _, t in rows:
        lines = (t or "").encode().split(b"\n")
        starts = np.cumsum([0] + [len(x) + 1 for x in lines])[:-1]
        if len(lines) > 1 and not lines[-1]:
            starts = starts[:-1]
        bounds = [*starts.tolist(), len((t or "").encode())]
        want = [0] * len(starts)
        at = 0
        ids = tool.encode(t or "", add_special_tokens=False).ids
        from furlong.llm.tokens import token_lengths
        for n in token_lengths(RANKS)[ids].tolist():
            held = [max(0, min(at + n, bounds[j + 1]) - max(at, bounds[j])) for j in range(len(starts))]
            want[held.index(max(held))] += 1
            at += n
        mine = sorted(got[i], key=lambda r: r["section"])
        mine = mine[:: len(mine) // len(want)] if len(mine) > len(want) else mine
        assert [r["n_tokens"] for r in mine] == want and [r["start_byte"] for r in mine] == starts.tolist()
        assert sum(want) == mine[0]["doc_tokens"] == len(ids)


def test_sections_of_an_empty_table(spark):
    assert counts.section_tokens(spark.createDataFrame([], "doc_id long, text string"), RANKS).count() == 0


FORGED = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def pages():
    rows = [(i, f"http://a/{i}", f"<p>{i % 40}</p>" * (i % 13)) for i in range(150)]
    rows += [(200, None, None), (201, "u\r\nx: y", ""), (202, "u", FORGED), (203, "u", FORGED + FORGED), (204, "u", "WARC/1.1\r\n"),
             (205, "ü", "é" * 5000 + "WARC/1.1\r\nContent-Length: 99999999\r\n\r\n"), (None, "u", "only null key"), (3, "u", "<p>3</p>" * 3),
             (206, "u", FORGED), (207, "u", "WARC/1.1\r\nContent-Length: -4\r\n\r\n"), (208, "u", "z" * 300_000 + FORGED)]
    return rows


def expected(rows):
    best = {}
    for i, _, h in rows:
        k = h or ""
        best[k] = i if best.get(k) is None else max(best[k], -1 if i is None else i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        k = best[h or ""]
        out.append((i, len(data), digest, *(("response", None) if i == k else ("revisit", k))))
    return sorted(map(str, out))


@pytest.mark.parametrize("split,compression", [("128m", "gzip"), ("4k", "none")])
def test_archives_round_trip(spark, tmp_path, split, compression):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        df = spark.createDataFrame(pages(), "page_id long, url string, html string").withColumn("size", F.lit(1)).repartition(2)
        got = warc.archived_pages(df, path=str(tmp_path / "w"), compression=compression).collect()
        assert sorted(str(tuple(r)) for r in got) == expected(pages())
        if compression == "none":
            assert any(os.path.getsize(tmp_path / "w" / f) > 100_000 for f in os.listdir(tmp_path / "w"))
        payloads = {r["record_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(spark, str(tmp_path / "w")).collect()
                    if r["type"] == "response"}
        assert payloads["<urn:page:203>"] == FORGED + FORGED and payloads["<urn:page:205>"].startswith("éé")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_pointers_jump_inside_compressed_files(spark, tmp_path):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"))
    links = warc.candidates(spark, str(tmp_path / "w")).filter("at >= 0").cache()
    assert links.select("file", "block").distinct().count() == 1
    nodes = warc.entry_nodes(warc.section_exits(warc.sectioned(links, 4096)))
    marked = {r["at"] for r in warc.reached(nodes).collect()}
    assert nodes.count() >= len(marked) > 8
    real, at, following = set(), 0, {r["at"]: r["next"] for r in links.collect()}
    while at in following:
        real.add(at)
        at = following[at]
    assert marked <= real and len(real) == len(pages()) < links.count()
    for size in (1, 4096, 1 << 30):
        assert {r["at"] for r in warc.reachable(links, size).collect()} == real
    read = [sorted(r["record_id"] for r in warc.read_archives(spark, str(tmp_path / "w"), size).collect()) for size in (4096, 1 << 30)]
    assert read[0] == read[1] and len(read[0]) == len(pages())


def test_archives_of_an_empty_table(spark):
    assert warc.archived_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "a"), (2, "u", "a"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.archived_pages(df, least=5).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_broken_archives_give_their_sound_records(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    (tmp_path / "cut.warc").write_text(record % (1, 3, "abc") + record % (2, 900, "cut"), newline="")
    (tmp_path / "lost.warc").write_text(record % (3, 2, "xy") + "WARC/1.1\r\nno header\r\n\r\n" + record % (4, 1, "z"), newline="")
    (tmp_path / "none.warc").write_text("", newline="")
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted((r["record_id"], bytes(r["payload"])) for r in got) == [("<urn:page:1>", b"abc"), ("<urn:page:3>", b"xy")]


def test_queries_match_added_tokens_as_the_unchanged_tokenizer_does(spark, tmp_path):
    from furlong.llm import queries

    unchanged = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert unchanged.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]
    rows = [*texts(), (200, "s0", "a<|endoftext|>b"), (201, "s1", "a  <|endoftext|><|endoftext|>\n\n b <|endoftext|"),
            (202, "s2", "<|endoftext|>"), (203, "s0", "line\n  <|endoftext|>\n" * 40)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    check_packing(unchanged, rows, queries.QUERIES["op4_packed"](spark, str(tmp_path)).collect(), packing.SEQUENCE)
    counted = {(r["doc_id"], r["doc_tokens"]) for r in queries.QUERIES["op6_section_tokens"](spark, str(tmp_path)).collect()}
    assert counted == {(i, len(unchanged.encode(t or "", add_special_tokens=False).ids)) for i, _, t in rows}
    sections = queries.QUERIES["op6_section_tokens"](spark, str(tmp_path)).filter("doc_id = 203").orderBy("section").collect()
    assert sum(r["n_tokens"] for r in sections) == sections[0]["doc_tokens"]
