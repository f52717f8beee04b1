import random

import pytest
from tokenizers import Tokenizer

from assayer.llm import packing, tokens

from .conftest import edge_rows


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(packing.default_tokenizer())


def n_tokens(plain, text):
    return len(plain.encode(text or "", add_special_tokens=False).ids)


def got(df):
    return sorted(map(repr, map(tuple, df.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())))


def brute(plain, docs, limit=2048):
    counts = [(d, len((t or "").encode()), n_tokens(plain, t)) for d, t in docs]
    return sorted(repr((*c, c[2] > limit)) for c in counts)


def test_documents(documents, texts, plain):
    assert got(tokens.counted(documents)) == brute(plain, texts.items())


def test_edge_rows(edge, nothing, plain):
    assert got(tokens.counted(edge, limit=20)) == brute(plain, [r[:2] for r in edge_rows()], 20)
    assert tokens.counted(nothing).collect() == []


def test_odd_texts(plain):
    count = tokens.TokenCounter(packing.default_tokenizer())
    odd = ["<|endoftext|>a<|startoftext|> b", "<|startof<|endoftext|>text|>", "İstanbul ŒUVRE é x́", "a\x1cb\x85c\xa0d e\x00f", "日本語 🙂🙂 ½²"]
    odd += ["a" * 5_000, "日本" * 3_000, "x" * (tokens.SLICE + 5), "ab " * (tokens.SLICE // 2), ""]
    rng = random.Random(1)
    pool = [chr(i) for i in [*range(600), 0x301, 0x2028, 0x3A3, 0x4E00, 0x1F642, 0xFB01, 0x200D]] + ["<|endoftext|>", " ", "\n"]
    odd += ["".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(2_000)]
    assert [count(t) for t in odd] == [n_tokens(plain, t) for t in odd]


def test_merges_equal_plain_search():
    """The heap against a search of all pairs for the lowest rank, again and again."""
    rng = random.Random(2)
    pairs, made = [], list("abc")
    while len(pairs) < 60:
        pair = (rng.choice(made), rng.choice(made))
        if pair not in pairs and len("".join(pair)) < 7:
            pairs.append(pair)
            made.append("".join(pair))
    merges, ranks = tokens.Merges(pairs), {p: i for i, p in enumerate(pairs)}
    for _ in range(500):
        symbols = rng.choices("abc", k=rng.randint(0, 40))
        left = list(symbols)
        while found := [(ranks[p], i) for i, p in enumerate(zip(left, left[1:])) if p in ranks]:
            at = min(found)[1]
            left[at : at + 2] = ["".join(left[at : at + 2])]
        assert len(symbols) - merges.count(list(symbols)) == len(left)


def test_remembered_runs_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 50)
    count = tokens.TokenCounter(packing.default_tokenizer())
    for i in range(500):
        count(f"word{i} other{i % 7}")
    assert len(count.plain) <= 50 and len(count.plain.old) <= 50


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "m.json"
    path.write_text('{"model": {"type": "BPE", "vocab": {"a": 0}, "merges": [], "unk_token": null}}')
    with pytest.raises(ValueError):
        tokens.TokenCounter(str(path))
