import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from assayer.llm import mixing as M

from .conftest import edge_rows


def filled(budget, nodes):
    """name -> (weight, capacity); exact level by which all are filled together, by repeated sharing of what is left."""
    open_, out, left = dict(nodes), {}, Fraction(budget)
    while open_:
        weight = sum(w for w, _ in open_.values())
        full = {n for n, (w, c) in open_.items() if Fraction(c) * weight <= left * w}
        if not full:
            return out | {n: left * w / weight for n, (w, _) in open_.items()}
        for n in full:
            out[n] = Fraction(open_.pop(n)[1])
            left -= out[n]
    return out


def brute_budgets(leaves, mix):
    """Leaf -> budget before rounding, from the root down; leaves: (domain, lang, source) -> tokens."""

    def weight(path):
        return mix.weights.get("/".join(x or "" for x in path), 1)

    def capacity(path):
        if path and weight(path) == 0:
            return 0
        if len(path) == 3:
            return leaves[path] * mix.epochs
        return sum(capacity(p) for p in below(path))

    def below(path):
        return sorted({leaf[: len(path) + 1] for leaf in leaves if leaf[: len(path)] == path}, key=str)

    out = {}

    def down(path, budget):
        if len(path) == 3:
            out[path] = budget
            return
        shares = filled(budget, {p: (weight(p), capacity(p)) for p in below(path)})
        for p, share in shares.items():
            down(p, share)

    down((), min(sum(leaves.values()) * mix.share[0] // mix.share[1], capacity(())))
    return out


TREE = [
    ("a", "en", "s1", 1_000), ("a", "en", "s2", 10), ("a", "de", "s3", 500), ("a", None, "s4", 70),
    ("b", "en", "s5", 3), ("b", "en", None, 9_000), ("b", "fr", "s6", 0), (None, "en", "s7", 400), ("c", "en", "s8", 77),
]


@pytest.mark.parametrize(
    "mix",
    [
        M.Mix(),
        M.Mix(weights={"a": 5, "b": 1, "a/en/s2": 9, "": 3}),
        M.Mix(weights={"c": 0, "b/en": 7, "a/de": 0}, share=(3, 1), epochs=3),
        M.Mix(share=(100, 1)),
        M.Mix(share=(0, 1)),
    ],
)
def test_budgets(spark, mix):
    df = spark.createDataFrame(TREE, "domain string, lang string, source string, tokens bigint")
    got = {tuple(r[:3]): r["budget"] for r in M.budgets(df, mix).collect()}
    exact = brute_budgets({t[:3]: t[3] for t in TREE}, mix)
    assert got.keys() == exact.keys()
    assert all(abs(got[k] - exact[k]) < 4 for k in exact)  # a token for rounding at each level
    assert sum(got.values()) == sum(exact.values())
    assert all(got[t[:3]] <= t[3] * mix.epochs for t in TREE)


def brute_mix(rows, budgets, mix):
    """(doc_id, epoch) of what is taken; rows: doc_id, leaf, tokens."""
    out, of = [], defaultdict(list)
    for d, leaf, n in rows:
        of[leaf].append((d, n))
    for leaf, docs in of.items():
        total = sum(n for _, n in docs)
        whole, rest = divmod(budgets[leaf], total) if total else (0, 0)
        out += [(d, e) for d, _ in docs for e in range(whole)]
        drawn = defaultdict(list)
        for d, n in docs:
            drawn[hashlib.md5(f"{mix.seed}:{whole}:{'null' if d is None else d}".encode()).hexdigest()].append((d, n))
        for draw in sorted(drawn):
            if rest <= 0:
                break
            out += [(d, whole) for d, _ in drawn[draw]]
            rest -= sum(n for _, n in drawn[draw])
    return sorted(map(repr, out))


def of_rows(df, mix, domain):
    rows = [
        (r["doc_id"], (r["domain"], r["lang"], r["source"]), len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")))
        for r in df.withColumn("domain", domain).collect()
    ]
    leaves = defaultdict(int)
    for _, leaf, n in rows:
        leaves[leaf] += n
    frame = df.sparkSession.createDataFrame([(*k, n) for k, n in leaves.items()], "domain string, lang string, source string, tokens bigint")
    budgets = {tuple(r[:3]): r["budget"] for r in M.budgets(frame, mix).collect()}
    return brute_mix(rows, budgets, mix), budgets, leaves


def test_documents_and_resampled_rows(documents):
    domain = M.source_domain()
    expected, budgets, leaves = of_rows(documents, M.DEFAULT, domain)
    taken = M.mixed(documents, M.DEFAULT, domain).collect()
    assert sorted(repr((r["doc_id"], r["epoch"])) for r in taken) == expected
    again = M.resampled(documents, M.DEFAULT, domain)
    assert again.columns == documents.columns and again.dtypes == documents.dtypes
    assert sorted(r["doc_id"] for r in again.select("doc_id").collect()) == sorted(r["doc_id"] for r in taken)
    used = defaultdict(int)
    for r in taken:
        used[r["domain"], r["lang"], r["source"]] += r["tokens"]
    assert all(0 <= used[k] - b < 6_000 for k, b in budgets.items())  # a leaf ends within its last document


def test_edge_rows(edge, nothing):
    mix = M.Mix(share=(3, 4))
    domain = F.when(F.col("source") == "a", F.lit("x"))
    expected, _, _ = of_rows(edge, mix, domain)
    assert sorted(repr((r["doc_id"], r["epoch"])) for r in M.mixed(edge, mix, domain).collect()) == expected
    assert M.resampled(edge, mix, domain).dtypes == edge.dtypes
    assert M.mixed(nothing, mix, domain).collect() == [] == M.resampled(nothing, mix, domain).collect()


def test_equal_documents_keep_the_order_of_epochs(spark):
    rows = [(i, "a b c", "en", "s") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    mix = M.Mix(share=(3, 2))
    taken = M.mixed(df, mix, F.lit("d")).collect()
    assert len(taken) == 150 and sum(r["epoch"] == 1 for r in taken) == 50
    assert M.mixed(df, mix, F.lit("d")).exceptAll(spark.createDataFrame(taken)).isEmpty()  # the same each time


def test_nothing_but_built_in_functions(documents):
    plan = M.mixed(documents, M.DEFAULT, M.source_domain())._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


