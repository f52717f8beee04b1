import math
from decimal import Decimal

import numpy as np
import pytest

from assayer.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>, component int, digest string, x int"


def brute(rows, components=16):
    """By row: (vec_id, n, deviation, whitened), components with any sign."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v):
            kept.append((vec_id, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]))
    if not kept:
        return [], None
    lengths = [len(x) for _, x in kept]
    length = max(set(lengths), key=lambda n: (lengths.count(n), n))
    kept = [(i, x) for i, x in kept if len(x) == length]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    covariance = centred.T @ centred / n
    values, unit = np.linalg.eigh(covariance)
    values, unit = values[::-1], unit[:, ::-1]
    used = min(components, int((values > 1e-12 * values.sum()).sum())) if values.sum() > 0 else 0
    out = []
    for i, x in kept:
        y = [n * c - s for c, s in zip(x, sums)]
        white = (np.array([c / n for c in y]) @ unit[:, :used]) / np.sqrt(values[:used])
        out.append((i, n, sum(c * c for c in y), np.abs(white)))
    return out, values[:used] / values.sum()


def same(df, rows, components=16):
    expected, explained = brute(rows, components)
    found = {}
    for r in df.collect():
        found.setdefault(r["vec_id"], []).append(r)
    wanted = {}
    for i, n, deviation, white in expected:
        for k, w in enumerate(white):
            wanted.setdefault(i, []).append((k + 1, n, deviation, w))
    assert found.keys() == wanted.keys()
    for i, all_ in wanted.items():
        got = sorted((r["component"], r["n"], int(r["deviation"]), abs(r["whitened"])) for r in found[i])
        for g, e in zip(got, sorted(all_), strict=True):
            assert g[:3] == e[:3] and g[3] == pytest.approx(e[3], rel=1e-6, abs=1e-8)
    for all_ in found.values():
        for r in all_:
            assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9) and r["identity_error"] < 1e-9


def vectors(seed, n, dims=5):
    rng = np.random.default_rng(seed)
    return [(i, [float(c) for c in rng.normal(size=dims) * np.arange(1, dims + 1)]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 9, "d", 4) for i, v in rows], SCHEMA).repartition(3)


def test_embeddings(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    same(W.whitened(df, "vec_id", "embedding"), [(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(1, 40)
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [nan] * 5), (104, [inf, 0.0, 0.0, 0.0, 0.0])]
    rows += [(105, [1.0, 2.0]), (0, rows[0][1]), (0, rows[0][1]), (106, rows[3][1]), (None, rows[4][1])]
    same(W.whitened(frame(spark, rows), "vec_id", "embedding", 3), rows, 3)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    found = W.whitened(frame(spark, rows), "vec_id", "embedding")
    assert found.collect() == [] and found.columns[0] == "vec_id"


def test_rank_bounds_components(spark):
    rows = [(i, [float(i), 2.0 * i, 0.5, -float(i * i)]) for i in range(30)]
    found = W.whitened(frame(spark, rows), "vec_id", "embedding").collect()
    assert {r["component"] for r in found} == {1, 2} and len(found) == 60
    assert len({tuple(r) for r in found}) == 60 and found[0]["identity_error"] < 1e-6


def test_many_blocks_and_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_CELLS", 35)
    monkeypatch.setattr(W, "HOT_COPIES", 20)
    rows = vectors(2, 60) + [(1_000 + i, vectors(2, 1)[0][1]) for i in range(50)]
    same(W.whitened(frame(spark, rows), "vec_id", "embedding"), rows)


def test_large_entries_are_exact(spark):
    rows = [(i, [c * 1e9 for c in v]) for i, v in vectors(3, 50)]
    found = W.whitened(frame(spark, rows), "vec_id", "embedding")
    assert isinstance(found.first()["deviation"], Decimal)
    same(found, rows)
