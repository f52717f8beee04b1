import random
import re

import numpy as np
import pytest
import xxhash

from assayer.llm import simhash as S
from assayer.llm.common import components

from .conftest import edge_rows

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, budget=3):
    """Least index that each fingerprint's links reach."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    values = np.array(prints, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= budget):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def flipped(rng, value, n):
    for b in rng.sample(range(64), n):
        value ^= 1 << b
    return value


def family(seed, size=400):
    """Fingerprints at random, chains of near ones, and dense groups."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(size // 2)}
    at = rng.getrandbits(64)
    for _ in range(size // 4):
        at = flipped(rng, at, rng.choice([1, 2, 3, 4]))
        out.add(at)
    centre = rng.getrandbits(64)
    out |= {flipped(rng, centre, rng.randint(0, 3)) for _ in range(size // 4)}
    return sorted(out)


def test_fingerprints(texts):
    odd = [None, "", " \n", "one", "one two", "ÄB ab\x1cC d", "a b c " * 5]
    for text in [*texts.values(), *odd]:
        assert S.text_fingerprint(text) == brute_fingerprint(text)


def test_bits_are_counted_in_parts(monkeypatch, texts):
    monkeypatch.setattr(S, "COUNTED", 5)
    for text in list(texts.values())[:20]:
        assert S.text_fingerprint(text) == brute_fingerprint(text)


def linked(spark, prints, **options):
    rows = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint bigint")
    links = S.linked_fingerprints(rows, options.pop("rows", len(prints)), **options)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    return [roots.get(signed(p), signed(p)) for p in prints]


def same_partition(labels, others):
    return len(set(zip(labels, others))) == len(set(labels)) == len(set(others))


@pytest.mark.parametrize("options", [{}, {"rows": 1 << 30}, {"rows": 1 << 33}, {"large": 20}, {"large": 3}])
def test_links_join_what_all_pairs_join(spark, options):
    """Other block orders (as for more rows), and buckets that are split."""
    prints = family(1)
    assert same_partition(linked(spark, prints, **options), brute_components(prints))


def test_split_buckets_hold_a_dense_group(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = sorted({flipped(rng, base, rng.randint(0, 6)) for _ in range(600)})
    assert same_partition(linked(spark, prints, large=50), brute_components(prints))


@pytest.mark.parametrize("seed", range(4))
def test_tries(seed, monkeypatch):
    """One trie over all, with little room for node pairs."""
    monkeypatch.setattr(S, "FRONTIER", 64)
    prints = family(seed)
    values = np.array(prints, np.uint64)
    tries = S._Tries(values, 3)
    tries.join(np.array([[0, len(values), 0, len(values), 0]]), 0)
    assert tries.label.tolist() == brute_components(prints)


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    loose = [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)]
    links = [*chain, *star, *loose, (5, 5), (7, 6), (7, 6)]
    rng.shuffle(links)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert found == {i: find(i) for i in root}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def brute_groups(rows):
    prints = sorted({brute_fingerprint(t) for _, t in rows})
    of = dict(zip(prints, brute_components(prints)))
    least = {}
    for d, t in rows:
        c = of[brute_fingerprint(t)]
        least[c] = min((x for x in (least.get(c), d) if x is not None), default=None)
    return [(d, f"{brute_fingerprint(t):016x}", least[of[brute_fingerprint(t)]]) for d, t in rows]


def groups(df):
    return [tuple(r) for r in S.grouped(df).select("doc_id", S.hex_fingerprint("fingerprint"), "component_id").collect()]


def test_documents(documents, texts):
    assert sorted(groups(documents)) == sorted(brute_groups(list(texts.items())))


def test_edge_rows(edge, nothing):
    rows = [r[:2] for r in edge_rows()]
    assert sorted(map(repr, groups(edge))) == sorted(map(repr, brute_groups(rows)))
    assert S.grouped(nothing).collect() == [] and S.one_each(nothing).collect() == []


def test_one_row_of_each_component_stays(edge, documents, texts):
    for df, rows in ((documents, list(texts.items())), (edge, [r[:2] for r in edge_rows()])):
        kept = S.one_each(df)
        assert kept.columns == df.columns
        expected = {c for _, _, c in brute_groups(rows)}
        found = [r["doc_id"] for r in kept.select("doc_id").collect()]
        assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_a_component_without_ids_keeps_one_row(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (1, "other words here now")], "doc_id bigint, text string")
    assert sorted(r["text"] for r in S.one_each(df).collect()) == ["a b c d", "other words here now"]
