"""The pipeline on a planted corpus: every decision takes effect and clean documents are left alone."""

import os
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as pipeline
from furlong import session

PARTS = {"xx": "ka ke ki ko ku sa se si so su ta te", "yy": "bra bre bri dro dru plo ple stra gle klo"}
WORD = re.compile(r"[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    rng = np.random.default_rng(9)

    def text(lang, n):
        parts = PARTS[lang].split()
        return ["".join(rng.choice(parts, int(rng.integers(2, 5)))) for _ in range(n)]

    rows, roles = [], {}

    def add(words, role, lang="xx", joint=" "):
        i = len(rows)
        rows.append((i, words if words is None or isinstance(words, str) else joint.join(words), lang, f"s{i % 3}",
                     None if words is None else len(joint.join(words))))
        roles[i] = role
        return i

    for i in range(60):
        lang = list(PARTS)[i % 2]
        add(text(lang, int(rng.integers(5, 300))), "clean", lang, joint="\n" if i % 3 else " ")
    base = text("xx", 200)
    for i in range(8):
        other = list(base)
        if i % 2:
            other[i * 20] = "kasetu"
        add(other, "near")
    passage = text("yy", 60)
    for _ in range(5):
        add(text("yy", 80) + passage + text("yy", 40), "passage", "yy")
    item = text("xx", 30)
    for _ in range(3):
        add(text("xx", 150) + item + text("xx", 50), "leak")
    for junk in (None, "", " 12 -- !", "\n"):
        add(junk, "junk", None)
    folder = tmp_path_factory.mktemp("tables")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    docs.repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "ka ke")], "item_id long, text string").write.parquet(
        str(folder / "benchmark.parquet"))
    tables, now = [], spark.read.parquet(str(folder / "documents.parquet"))
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, now, str(folder)).write.parquet(str(folder / f"out{k}"))
        now = spark.read.parquet(str(folder / f"out{k}"))
        tables.append({r["doc_id"]: r for r in now.collect()} if k < 4 else now.collect())
    again = pipeline.run(spark, str(folder)).collect()
    return rows, roles, passage, tables, docs.columns, again


def test_stages_keep_the_columns(result):
    for table in result[3][:4]:
        assert list(next(iter(table.values())).asDict()) == result[4]


def test_only_junk_has_no_language(result):
    _, roles, _, tables, *_ = result
    assert set(tables[0]) == {i for i, role in roles.items() if role != "junk"}


def test_one_near_copy_stays(result):
    _, roles, _, tables, *_ = result
    assert sum(roles[i] == "near" for i in tables[1]) == 1
    assert {i for i in tables[1] if roles[i] != "near"} == {i for i in tables[0] if roles[i] != "near"}


def test_repeated_words_go_and_the_rest_stays_byte_for_byte(result):
    rows, roles, passage, tables, *_ = result
    before = {i: WORD.findall(r["text"]) for i, r in tables[1].items()}
    seen = Counter(tuple(w[i:i + 35]) for w in before.values() for i in range(len(w) - 34))
    assert set(tables[2]) == set(tables[1])
    for i, r in tables[2].items():
        words, gone = before[i], [False] * len(before[i])
        for j in range(len(words) - 34):
            if seen[tuple(words[j:j + 35])] > 1:
                gone[j:j + 35] = [True] * 35
        assert WORD.findall(r["text"]) == [w for w, g in zip(words, gone, strict=True) if not g]
        if not any(gone):
            assert r == tables[1][i]
        else:
            assert r["n_chars"] == len(r["text"]) and roles[i] == "passage"


def test_documents_with_items_go(result):
    _, roles, _, tables, *_ = result
    assert set(tables[3]) == {i for i in tables[2] if roles[i] != "leak"}


def test_every_remaining_id_is_packed_once(result):
    *_, tables, _, again = result
    assert sorted(map(tuple, again)) == sorted(map(tuple, tables[4]))
    covered = Counter()
    for p in tables[4]:
        covered[p["doc_id"]] += p["length"]
    assert covered == {p["doc_id"]: p["doc_tokens"] for p in tables[4]} and set(covered) == set(tables[3])


def test_empty_documents_pass_all_stages(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int")
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b c d e")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_keep_the_right_rows_if_the_scan_is_cut_anew(spark, tmp_path):
    """Executors come and go between the jobs of a stage, which changes the splits of a scan."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 5000, 60 + i)), "xx", "s") for i in range(24)]
    rows += [(100 + i, rows[i][1], "xx", "s") for i in range(0, 24, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    try:
        spark.conf.set(names[0], "6")
        kept = pipeline.near_duplicates(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
        spark.conf.set(names[0], "1")
        spark.conf.set(names[1], "1")
        texts = [r["text"] for r in kept.collect()]
    finally:
        for name in names:
            spark.conf.unset(name)
    assert len(texts) == 24 and set(texts) == {r[1] for r in rows}


def test_a_run_leaves_its_result_alone_in_scratch(spark, tmp_path, monkeypatch):
    rows = [(i, f"some words of document number {i} that are not very many " * 3, "en", f"s{i % 2}", 9) for i in range(40)]
    rows[7] = (7, rows[6][1], "en", "s0", 9)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b c d e")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    tables = {t.name for t in spark.catalog.listTables()}
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "scratch"))
    assert pipeline.run(spark, str(tmp_path)).count() > 0
    left = [os.path.relpath(d, tmp_path / "scratch") for d, _, names in os.walk(tmp_path / "scratch") if names]
    assert len(left) == 1 and "/pack-" in left[0]
    assert {t.name for t in spark.catalog.listTables()} == tables
