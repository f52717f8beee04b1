"""The corpus pipeline stage by stage, each against what a plain reading of its input gives."""

import hashlib

import pytest

import corpus_pipeline as P
from assayer.llm import mixing, quality
from assayer.llm.common import kept

from . import test_lines, test_mixing, test_simhash
from .test_packing import check_pieces, ids_of, plain  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark, documents, sf):
    """Rows before and after each stage."""
    frames = [documents]
    for name, stage in P.STAGES:
        frames.append(kept(stage(spark, frames[-1], sf), "test-stage"))
    return frames


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_and_names(stages, documents):
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "near-duplicates", "source mix", "packing"]
    for df in stages[:-1]:
        assert df.columns == documents.columns and df.dtypes == documents.dtypes


def test_quality_rules(stages, documents):
    judged = {r["doc_id"] for r in quality.judged(documents, False).filter("kept").select("row.doc_id").collect()}
    before, after = by_id(stages[0]), by_id(stages[1])
    assert after.keys() == judged and 0 < len(after) < len(before)
    assert all(after[d] == before[d] for d in after)


def test_line_dedup(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    expected = test_lines.brute([(d, r["text"]) for d, r in before.items()])
    got = []
    for d, r in after.items():
        n = before[d]["text"].count("\n") + 1
        got.append((d, n, hashlib.sha256(r["text"].encode()).hexdigest()))
        assert r["n_chars"] == len(r["text"]) and (r["lang"], r["source"]) == (before[d]["lang"], before[d]["source"])
    assert sorted(map(repr, got)) == sorted(repr((e[0], e[1], e[3])) for e in map(eval, expected))


def test_near_duplicates(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    groups = test_simhash.brute_groups([(d, r["text"]) for d, r in before.items()])
    assert after.keys() == {c for _, _, c in groups} and len(after) < len(before)
    assert all(after[d] == before[d] for d in after)


def test_source_mix(stages):
    expected, _, _ = test_mixing.of_rows(stages[3], mixing.DEFAULT, mixing.source_domain())
    before = by_id(stages[3])
    rows = stages[4].collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(eval(e)[0] for e in expected)
    assert all(r == before[r["doc_id"]] for r in rows)


def test_packing(stages, plain):  # noqa: F811
    expected = {}
    for r in stages[4].collect():
        expected.setdefault(r["doc_id"], []).append(ids_of(plain, r["text"]))
    check_pieces(stages[5].collect(), expected, 2048)


def test_run(spark, sf, stages):
    assert sorted(map(str, P.run(spark, sf).select("doc_id", "doc_tokens").distinct().collect())) == sorted(
        map(str, stages[5].select("doc_id", "doc_tokens").distinct().collect())
    )


def test_edge_rows(spark, edge, nothing, sf):
    for start in (edge, nothing):
        df = start
        for _, stage in P.STAGES:
            df = kept(stage(spark, df, sf), "test-edge")
        assert set(df.columns) >= {"doc_id", "sequence_id", "ids"}
