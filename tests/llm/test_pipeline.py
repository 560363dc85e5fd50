"""The pipeline's stages, each against a plain version on its own input."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from test_operators import _brute_components, _brute_lines, _check_packing  # noqa: E402

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages(spark):
    from tidelog.llm.common import written
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(90_001, None, None, "s", 0), (90_002, "", "en", "s", 0), (90_003, "12 34", "en", None, 5)], docs.schema)
    docs = docs.union(extra)
    columns, rows = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = written(stage(spark, docs, SF), name)
        rows.append((name, before, {r.doc_id: r for r in docs.collect()}, docs.columns))
    assert [r[0] for r in rows] == ["language", "line_dedup", "near_duplicates", "personal_data", "packing"]
    for _, _, after, names in rows[:4]:
        assert names == columns
        assert all(r.n_chars == len(r.text) for r in after.values())
    assert set(rows[0][1]) - set(rows[0][2]) == {90_001, 90_002, 90_003}
    before, after = rows[1][1:3]
    want = _brute_lines({i: r.text for i, r in before.items()})
    assert {i: r.text for i, r in after.items()} == {
        i: t for i, t in want.items() if t == before[i].text or t.strip(" ") != ""}
    before, after = rows[2][1:3]
    want = _brute_components({i: r.text for i, r in before.items()})
    assert {i: r.text for i, r in after.items()} == {i: before[i].text for i in before if want[i][1] == i}
    before, after = rows[3][1:3]
    assert set(before) == set(after)
    assert any(before[i].text != after[i].text for i in before)
    packed = [tuple(r) for r in docs.collect()]
    _check_packing(packed, [(i, r.text) for i, r in rows[4][1].items()], 4096)


def test_run_equals_the_stages_one_by_one(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_near_duplicates_of_missing_and_shared_ids(spark):
    words = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcdef"]
    near = words[0] + " tail"
    rows = [(1, words[0]), (2, near), (3, words[1]), (3, words[2]), (3, words[2]), (3, words[1] + " tail"),
            (None, words[3]), (None, words[3]), (None, near), (None, words[4]), (4, words[5]), (None, None), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r)[:2] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    texts = sorted((t[:2] if t else "") for _, t in got)
    # one of each group, and both rows without text, which are near no other
    assert texts == ["", "", "a0", "b0", "c0", "d0", "e0", "f0"]
    assert (1, words[0]) in got and (4, words[5]) in got and (5, None) in got


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
