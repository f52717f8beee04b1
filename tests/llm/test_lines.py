import hashlib
from collections import defaultdict

import numpy as np
import pytest

from assayer.llm import lines as L

from .conftest import edge_rows

STRIP = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least_chars=40, least_docs=5):
    docs = defaultdict(set)
    split = [(d, (t or "").split("\n")) for d, t in rows]
    for d, lines in split:
        for line in lines:
            key = line.strip(STRIP).translate(LOWER)
            if len(key) >= least_chars:
                docs[key].add(d)

    def goes(d, line):
        key = line.strip(STRIP).translate(LOWER)
        known = {x for x in docs[key] if x is not None}
        return len(key) >= least_chars and len(docs[key]) >= least_docs and d != max(known, default=None)

    out = []
    for d, lines in split:
        kept = [x for x in lines if not goes(d, x)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(map(repr, out))


def got(df, **options):
    return sorted(repr(tuple(r)) for r in L.digest(L.deduplicated(df, **options)).collect())


@pytest.mark.parametrize("broadcast_bytes", [L.BROADCAST_BYTES, 0])
def test_documents(documents, texts, broadcast_bytes):
    """Arrays sent to the tasks, and lines brought to the arrays."""
    assert got(documents, broadcast_bytes=broadcast_bytes) == brute(list(texts.items()))
    options = {"least_chars": 10, "least_docs": 2, "broadcast_bytes": broadcast_bytes}
    assert got(documents, **options) == brute(list(texts.items()), 10, 2)


def shared_lines():
    common = "This line is long enough and stands in many documents"
    rows = [(i, f"own text {i}\n  {common.upper()}\t\n{common}\nÉé {common}") for i in range(6)]
    rows += [(5, common), (5, common), (None, common), (None, "only without ids, which is one document and no more"), (9, None), (10, ""), (11, "\n\n")]
    rows += [(None, "only without ids, which is one document and no more")] * 6
    rows += [(20 + i, "short of a letter: thirty-nine points.." + " " * i) for i in range(6)]
    rows += [(30 + i, "é" * 40) for i in range(5)] + [(40 + i, "É" * 40) for i in range(4)]
    return rows


@pytest.mark.parametrize("broadcast_bytes", [L.BROADCAST_BYTES, 0])
def test_shared_lines(spark, broadcast_bytes, monkeypatch):
    monkeypatch.setattr(L, "SHARD_KEYS", 1)  # several shards
    monkeypatch.setattr(L, "GROUP_LINES", 2)  # each in several tasks
    df = spark.createDataFrame(shared_lines(), "doc_id bigint, text string").repartition(4)
    assert got(df, broadcast_bytes=broadcast_bytes) == brute(shared_lines())


def test_edge_rows(edge, nothing):
    rows = [r[:2] for r in edge_rows()]
    assert got(edge) == brute(rows) and got(edge, broadcast_bytes=0) == brute(rows)
    assert got(nothing) == [] and got(nothing, broadcast_bytes=0) == []
    clean = L.cleaned(edge)
    assert clean.columns == edge.columns and clean.dtypes == edge.dtypes
    by_id = {r["doc_id"]: r for r in clean.collect()}
    assert by_id[1]["text"] == "" and by_id[8]["n_chars"] == len(edge_rows()[-1][1]) and by_id[8]["row"] == "x"


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    high, low = (rng.integers(0, 2**64, n, np.uint64) for _ in range(2))
    if n > 4:
        high[: n // 2] = high[0]  # keys that share a half
    built = L.PerfectHash.build(high, low)
    assert sorted(built.index(high, low)) == list(range(n))
    assert sum(size for size, _ in built.levels) <= 6 * n + 64 * 12
    others = built.index(low + np.uint64(1), high)
    assert ((others >= -1) & (others < max(n, 1))).all()
