import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from assayer.llm import fingerprints as B

from .conftest import edge_rows


def brute_sketch(text, k=B.K, shingle=B.SHINGLE):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    out = set()
    for i in range(max(1, len(words) - shingle + 1) if words else 0):
        seed = 42
        for h in hashes[i : i + shingle]:
            seed = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)
        out.add(seed >> 1)
    return sorted(out)[:k]


def brute_resemblance(a, b, k=B.K):
    union = sorted({*a, *b})[:k]
    return len({*a} & {*b} & {*union}) / len(union) if union else 1.0


def brute(docs):
    """By row: what `compared_with_edited` gives; equal rows are one document."""
    docs = list(docs)
    rows = sorted({(d, t or "") for d, t in docs}, key=lambda r: (r[0] is None, -(r[0] or 0), as_signed(xxhash.xxh64_intdigest(r[1].encode(), 42))))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = brute_sketch(text), brute_sketch(edited), brute_sketch(after)
        row = (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, brute_resemblance(a, b), brute_resemblance(a, c))
        out += [row] * sum((d, t or "") == (doc_id, text) for d, t in docs)
    return sorted(map(repr, out))


def as_signed(x):
    return x - (1 << 64) if x >> 63 else x


def got(df):
    return sorted(repr(tuple(r)) for r in df.select("doc_id", "n_chars", "edited_sha256", "sketch", "edited_sketch", "near_edited", "near_next").collect())


def test_documents(documents, texts):
    assert got(B.compared_with_edited(documents)) == brute(texts.items())


def test_edge_rows(edge, nothing):
    assert got(B.compared_with_edited(edge)) == brute([r[:2] for r in edge_rows()])
    assert B.compared_with_edited(nothing).collect() == []


def test_repeated_rows_keep_their_rows(spark, monkeypatch):
    rows = [(i, f"t{i} " * 9) for i in range(30)] * 2 + [(3, None)] * 3 + [(3, "")] * 2 + [(7, "t7 " * 9)] * 40
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert got(B.compared_with_edited(df)) == brute(rows)
    monkeypatch.setattr(B, "COPIES_PER_TASK", 7)
    assert got(B.compared_with_edited(df)) == brute(rows)


def test_one_document_follows_itself(spark):
    df = spark.createDataFrame([(3, "a b c d e f g h i")], "doc_id bigint, text string")
    assert got(B.compared_with_edited(df)) == brute([(3, "a b c d e f g h i")])


def test_parts_merge_and_estimates_are_near(spark):
    words = [f"w{i}" for i in range(3_000)]
    rows = [(" ".join(words), " ".join(words[:2_000]), " ".join(words[1_996:]), " ".join(words[1_500:]))]
    df = spark.createDataFrame(rows, "whole string, head string, tail string, half string")
    for name in df.columns:
        df = B.with_sketch(df, F.col(name), f"{name}_sketch")
    w, h, t, half = (F.col(f"{n}_sketch") for n in ("whole", "head", "tail", "half"))
    row = df.select(
        (B.merged(h, t) == w).alias("same"),
        B.distinct_shingles(w).alias("n"),
        B.resemblance(w, half).alias("near"),
        B.containment(half, w).alias("inside"),
        B.containment(w, half).alias("part"),
        B.text_form(w).alias("text"),
    ).first()
    assert row["same"] and abs(row["n"] / 2_996 - 1) < 0.3
    assert row["near"] == pytest.approx(0.5, abs=0.15) and row["inside"] > 0.75 and row["part"] == pytest.approx(0.5, abs=0.2)
    assert re.fullmatch(rf"[0-9a-f]{{{16 * B.K}}}", row["text"])


def test_nothing_but_built_in_functions(documents):
    plan = B.compared_with_edited(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
