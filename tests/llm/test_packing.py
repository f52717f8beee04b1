import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from assayer.llm import packing
from assayer.llm.packing import best_cuts, cut_points, packed

from .conftest import edge_rows


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(packing.default_tokenizer())


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(rows, expected, window):
    """`expected`: ids of each document, by doc_id. Pieces cover them, windows are gapless and not too long."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_window[r["sequence_id"]].append(r)
    left = {d: list(all_) for d, all_ in expected.items()}
    for doc_id, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["start"])
        for documents in [p for p in pieces if p["start"] == 0]:
            assert any(len(ids) == documents["doc_tokens"] for ids in left[doc_id])
        covered = defaultdict(int)
        for p in pieces:
            covered[p["doc_tokens"]] += p["length"]
            assert any(
                zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"]
                for ids in left[doc_id]
                if len(ids) == p["doc_tokens"]
            )
            assert p["ids"] is None or len(p["ids"]) == p["length"]
        assert covered == {n: n * sum(len(i) == n for i in left[doc_id]) for n in {len(i) for i in left[doc_id]}}
    assert by_doc.keys() == left.keys()
    for pieces in by_window.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window


def test_ids_are_the_tokenizers(plain, texts):
    encode = packing.Encoder(packing.default_tokenizer())
    odd = ["Σίσυφος ΟΔΥΣΣΕΥΣ it's I'LL", "<|endoftext|>a<|startoftext|> b", "İstanbul ŒUVRE é x́", "a\x1cb\x85c\xa0d e\x00f", "日本語 🙂🙂 ½²", "ŉ ſ µ ª 's'S"]
    for text in [*texts.values(), *odd]:
        assert encode(text) == np.array(ids_of(plain, text)[:-1], "<u4").tobytes()


def test_long_texts_are_encoded_in_slices(plain, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 50)
    encode = packing.Encoder(packing.default_tokenizer())
    text = "Some words, it's said; " * 40 + "x" * 200 + " end"
    assert encode(text) == np.array(ids_of(plain, text)[:-1], "<u4").tobytes()


def test_cache_generations(monkeypatch, plain, texts):
    monkeypatch.setattr(packing, "CACHED", 10)
    encode = packing.Encoder(packing.default_tokenizer())
    for text in list(texts.values())[:30]:
        assert encode(text) == np.array(ids_of(plain, text)[:-1], "<u4").tobytes()
    for cache in (encode.pieces, encode.plain, encode.other):
        assert len(cache) <= 10 and len(cache.old) <= 10


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_the_best_of_all(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 60) for _ in range(rng.randint(1, 6))]
    ends = np.array(sorted(rng.sample(range(1, sum(lengths) + 1), min(5, sum(lengths)))))
    window = 48
    places, cost = cut_points(lengths, ends, window)
    places, cost = places.tolist(), cost.tolist()
    least = [0] + [None] * (len(places) - 1)
    for j in range(1, len(places)):
        least[j] = min(least[i] + window - (places[j] - places[i]) + cost[j] for i in range(j) if places[j] - places[i] <= window and least[i] is not None)
    cuts = best_cuts(places, cost, window)
    assert cuts[0] == 0 and cuts[-1] == len(places) - 1
    spent = sum(window - (places[b] - places[a]) + cost[b] for a, b in zip(cuts, cuts[1:]))
    assert spent == least[-1] and all(places[b] - places[a] <= window for a, b in zip(cuts, cuts[1:]))


def test_documents(documents, texts, plain):
    rows = packed(documents).collect()
    check_pieces(rows, {d: [ids_of(plain, t)] for d, t in texts.items()}, 2048)
    used = sum(r["length"] for r in rows)
    assert used / (2048 * len({r["sequence_id"] for r in rows})) > 0.97


def test_windows_keep_the_order(spark, monkeypatch):
    rows = [(i, f"short text number {i}. and more") for i in range(200)]
    out = packed(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), window=64).collect()
    out.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    assert [(r["doc_id"], r["start"]) for r in out] == sorted((r["doc_id"], r["start"]) for r in out)


def test_blocks_leave_no_short_window(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 500)
    packer = packing._Packer(np.zeros(10, bool), 64, 0)
    for i in range(50):
        packer.add(i, np.full(37, 3, "<u4"))
    packer.pack(last=True)
    check = defaultdict(int)
    for _, _, length, _, _, sequence, _, _ in packer.out:
        check[sequence] += length
    assert sum(check.values()) == 50 * 37 and max(check.values()) <= 64
    assert sorted(check) == list(range(len(check)))


def test_edge_rows(edge, nothing, plain):
    expected = defaultdict(list)
    for row in edge_rows():
        expected[row[0]].append(ids_of(plain, row[1]))
    check_pieces(packed(edge).collect(), expected, 2048)
    assert packed(nothing).collect() == []
    assert "ids" not in packed(nothing, with_ids=False).columns
