import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from assayer.llm import divergence as D
from assayer.llm.common import kept

from .conftest import edge_rows

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, least=10, top=10):
    """`docs`: (text, lang, source)."""
    rows = [(Counter(t.translate(LOWER) for t in TERM.findall(text or "")), lang or "", source or "") for text, lang, source in docs]
    in_docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for terms, lang, source in rows:
        in_docs[lang].update(terms.keys())
        groups[lang].add(source)
    kept_terms = {lang: sorted(t for t, n in c.items() if n >= least) for lang, c in in_docs.items()}
    for terms, lang, source in rows:
        for t in {*terms} & {*kept_terms[lang]}:
            counts[lang, source][t] += terms[t]
            counts[lang, None][t] += terms[t]

    def share(lang, source, term):
        own = counts[lang, source]
        return 1 + 10**9 * (own[term] + 2) // (sum(own.values()) + 2 * len(kept_terms[lang]))

    out = []
    for lang, sources in groups.items():
        terms = kept_terms[lang]
        p = {s: [share(lang, s, t) for t in terms] for s in [*sources, None]}
        for s in sources:
            pairs = [(o, sum((a - b) ** 2 // (a + b) for a, b in zip(p[s], p[o]))) for o in sources if o != s]
            best = [(t, (a - b) ** 2 // (a + b)) for t, a, b in zip(terms, p[s], p[None]) if counts[lang, s][t] and a > b]
            for part, items, most in (("pair", pairs, None), ("term", best, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(map(repr, out))


def got(df):
    return sorted(map(repr, map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect())))


def test_documents(documents):
    rows = [(r["text"], r["lang"], r["source"]) for r in documents.collect()]
    assert got(D.audited(documents)) == brute(rows)


def test_edge_rows(edge, nothing):
    rows = [r[1:4] for r in edge_rows()]
    assert got(D.audited(edge, 1)) == brute(rows, 1)
    assert got(D.audited(edge, 2, 3)) == brute(rows, 2, 3)
    assert got(D.audited(edge, 99)) == brute(rows, 99)  # no term is kept
    assert D.audited(nothing).collect() == []


LONG = "x" * 300
TEXTS = [
    "alpha alphabet alphabets ALPHA ünï Ünï é" if i % 2 else f"alpha1alphb {LONG}{'y' if i % 3 else ''} {'z' * (i % 40)} 日本語 日本 {'日' * (i % 9)}"
    for i in range(60)
]


@pytest.fixture(scope="module")
def made(spark):
    rows = [(t, "en" if i % 5 else "", ["a", "b", None, "é"][i % 4]) for i, t in enumerate(TEXTS)]
    return rows, spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)


def test_prefixes_of_every_length(made):
    """Terms of one byte to 301, shared and own prefixes, prefixes that end within a character."""
    rows, df = made
    for least in (1, 3, 10):
        assert got(D.audited(df, least)) == brute(rows, least)


def test_a_crowded_filter_loses_nothing(made, monkeypatch):
    """A filter that lets every prefix through: the counts alone decide."""
    rows, df = made
    monkeypatch.setattr(D.Filter, "of", classmethod(lambda cls, stayed: cls(bytearray(b"\xff" * (D.FILTER_BITS // 8)))))
    assert got(D.audited(df, 3)) == brute(rows, 3)


def test_filter_places_are_sparks(spark):
    rows = [("en", bytes([i])) for i in range(1, 120)] + [("", b"\xc3"), ("ü", b"abc")]
    found = D.Filter.of(spark.createDataFrame(rows, "lang string, prefix binary"))
    assert all(found(lang.encode(), prefix) for lang, prefix in rows)
    assert sum(x.bit_count() for x in found.bits) == len(rows) and not found(b"en", b"zz")


def test_rare_prefixes_go_no_further(made):
    _, df = made
    rows = kept(D.tokenised(df), "test-terms")
    first = D._first_level(rows).filter("docs >= 10")
    bits = df.sparkSession.sparkContext.broadcast(bytes(D.Filter.of(first.filter("hex(prefix) NOT LIKE '%00'")).bits))
    second = D._next_level(rows, 16, 8, bits).collect()
    stayed = {(r["lang"], bytes(r["prefix"])) for r in first.collect()}
    assert second and all((r["lang"], bytes(r["prefix"])[:8]) in stayed for r in second)


def test_counts_beyond_64_bits():
    assert D.shares([10**12], 10**13, 5).tolist() == [1 + 10**9 * (10**12 + 2) // (10**13 + 10)]


def test_small_blocks_of_rows_and_terms(made, monkeypatch):
    """Sizes that the workers read from the functions' own module, so small data have to do: one row a partition."""
    rows, df = made
    assert got(D.audited(df.repartition(60), 3)) == brute(rows, 3)


def test_blocks_are_closed_when_full(monkeypatch):
    gathered = D._Gathered("en")
    assert [gathered.add(t, s) for t, s in ((b"B a b", "x"), (b"", "y"), (b"abcde abcd a", "x"))] == [2, 0, 3]
    block = next(D._blocks([gathered.out()]))
    assert block.terms == [b"a", b"abcd", b"abcde", b"b"] and block.sources == ["x", "y"] and block.source_of.tolist() == [0, 1, 0]
    assert sorted(zip(block.row.tolist(), block.codes.tolist(), block.counts.tolist())) == [(0, 0, 1), (0, 3, 2), (2, 0, 1), (2, 1, 1), (2, 2, 1)]


def test_best_terms_over_chunks_with_ties():
    draw = np.random.default_rng(5)
    for most in (1, 3, 10):
        value = draw.integers(-1, 6, (200, 4))
        value[:, 3] = -1  # a source without any
        terms = np.array([f"t{i:03}" for i in range(200)], object)
        best = D._Best(4, most)
        for cut in np.split(np.arange(200), [1, 7, 7, 90]):
            best.add(terms[cut], value[cut])
        for k in range(4):
            expected = sorted((-v, t) for v, t in zip(value[:, k].tolist(), terms) if v >= 0)[:most]
            assert list(zip((-best.values[k]).tolist(), best.terms[k])) == expected
