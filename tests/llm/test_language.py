import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from assayer.llm import language as G

from .conftest import edge_rows


def brute_counts(text, dims):
    """N-grams of the letters and single blanks, each run of others being one."""
    points, before = [], True
    for c in text.lower():
        p = ord(c)
        letter = 97 <= p <= 122 or p >= 0xC0 and p not in (0xD7, 0xF7) and not 0x2000 <= p < 0x2E80
        if letter or before or not points:
            points.append(p if letter else 32)
        before = letter
    counts, m = np.zeros(dims, np.int64), (1 << 64) - 1
    for n in (1, 2, 3):
        for i in range(len(points) - n + 1):
            h = points[i]
            for p in points[i + 1 : i + n]:
                h = (h * 0x100000001B3 + p) & m
            counts[(((h + n) * 0x9E3779B97F4A7C15 & m) >> 40) % dims] += 1
    return counts


def test_ngrams(texts):
    for text in [*list(texts.values())[:50], "a", "ab", " a  b1c ", "日本 × Ünï", "12 34", "."]:
        assert (G.ngram_counts(text, 512) == brute_counts(text, 512)).all()


@pytest.fixture(scope="module")
def model(documents):
    return G.fitted(documents)


def test_held_out_accuracy_and_calibration(spark, documents, model):
    rows = G.identified(documents, model).collect()
    lang = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held)
    assert right > 0.98
    assert abs(sum(r["score"] for r in held) / len(held) - right) < 0.05
    assert all(0 <= r["score"] <= 1 for r in rows)
    wide = documents.withColumnsRenamed({"lang": "other", "source": "score"}).select("doc_id", "text", "other", "score")
    assert sorted(map(tuple, G.identified(wide, model).collect())) == sorted(map(tuple, rows))  # from the text alone


def test_model_is_sparse_and_knows_the_labels(model):
    assert model.languages == ["de", "en", "es", "fr"] and 0 < model.temperature < math.inf
    assert (model.weights == 0).mean() > 0.1


def test_statistics_cover_all_learned_rows(documents, texts):
    rows = documents.filter(~G.held_out())
    found = G._document_frequency(rows, 1 << 10)
    total = np.zeros(1 << 10, np.int64)
    for d, t in texts.items():
        if zlib.crc32(str(d).encode()) % 3 != 1:
            total += G.ngram_counts(t, 1 << 10) > 0
    assert (found == total).all()


def test_sample_is_bounded_also_for_repeated_rows(spark):
    learned = next(i for i in range(10) if zlib.crc32(str(i).encode()) % 3 != 1)
    rows = [(learned, "the same text", "en")] * 300 + [(i, f"der text {i}", "de") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    model = G.fitted(df, G.Settings(dims=256, sample_rows=40, least_per_language=5, epochs=1))
    assert model.languages == ["de", "en"] and model.predict("der text")[0] == "de"


def test_temperature():
    rng = np.random.default_rng(0)
    classes = rng.integers(0, 2, 4_000)
    p = np.where(rng.random(4_000) < 0.8, classes, 1 - classes)
    logits = np.stack([np.where(p == 0, 10.0, 0.0), np.where(p == 0, 0.0, 10.0)], axis=1)
    t = G.temperature(logits, classes)
    assert 1 / (1 + math.exp(-10 / t)) == pytest.approx(0.8, abs=0.02)
    assert G.temperature(np.zeros((0, 2)), np.zeros(0, int)) == 1.0


def test_edge_rows(edge, nothing, model):
    rows = defaultdict(set)
    for r in G.identified(edge, model).collect():
        rows[r["doc_id"]].add((r["lang_pred"], r["score"]))
    assert rows[1] == rows[2] == rows[3] == {("und", 0.0)} and ("und", 0.0) in rows[None]
    assert all(lang in model.languages for lang, _ in rows[4] | rows[6] | rows[7])
    assert sum(1 for _ in edge_rows()) == G.identified(edge, model).count()
    assert G.identified(nothing, model).collect() == []
    blank = G.fitted(nothing)
    assert blank.languages == [] and {tuple(r[2:]) for r in G.identified(edge, blank).collect()} == {("und", 0.0)}
    assert G.fitted(edge).languages  # learns from what there is


def plain_softmax(x):
    e = [math.exp(v - max(x)) for v in x]
    return [v / sum(e) for v in e]


def plain_features(text, idf, dims):
    counts = brute_counts(text, dims)
    values = {i: (1 + math.log(counts[i])) * idf[i] for i in range(dims) if counts[i]}
    norm = math.sqrt(sum(v * v for v in values.values())) or 1.0
    return {**{i: v / norm for i, v in values.items()}, dims: 1.0}


def plain_ftrl(rows, classes, n_classes, s):
    """Follow-the-regularised-leader, one weight at a time."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(c, i):
        if abs(z[c, i]) <= s.l1:
            return 0.0
        return -(z[c, i] - math.copysign(s.l1, z[c, i])) / ((s.beta + math.sqrt(n[c, i])) / s.alpha + s.l2)

    order = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for row in order.permutation(len(rows)):
            w = {(c, i): weight(c, i) for c in range(n_classes) for i in rows[row]}
            p = plain_softmax([sum(w[c, i] * v for i, v in rows[row].items()) for c in range(n_classes)])
            for c in range(n_classes):
                for i, v in rows[row].items():
                    g = (p[c] - (c == classes[row])) * v
                    z[c, i] += g - (math.sqrt(n[c, i] + g * g) - math.sqrt(n[c, i])) / s.alpha * w[c, i]
                    n[c, i] += g * g
    return weight


def test_labels_and_scores_by_brute_force(documents):
    """Fitting and predicting by plain loops over the rows that may be learned from."""
    s = G.Settings(dims=128, epochs=2)
    docs = documents.filter("doc_id < 90")
    place = (F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(s.seed)), F.lit(1 << 30)) / float(1 << 30)).alias("place")
    rows = docs.select("doc_id", "text", "lang", place).collect()
    learned = sorted((r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1), key=lambda r: (r["place"], r["lang"], r["text"]))
    languages = sorted({r["lang"] for r in learned})
    found = [brute_counts(r["text"], s.dims) > 0 for r in learned]
    idf = [math.log((1 + len(learned)) / (1 + sum(f[i] for f in found))) + 1 for i in range(s.dims)]
    features = [plain_features(r["text"], idf, s.dims) for r in learned]
    classes = [languages.index(r["lang"]) for r in learned]
    train, back = ([i for i in range(len(learned)) if (i % 5 == 4) is held] for held in (False, True))
    weight = plain_ftrl([features[i] for i in train], [classes[i] for i in train], len(languages), s)

    def logits(values):
        return [sum(weight(c, i) * v for i, v in values.items()) for c in range(len(languages))]

    doubt = 1 / (len(back) + 2)

    def loss(t):
        total = 0.0
        for i in back:
            p = plain_softmax([x / t for x in logits(features[i])])
            total -= sum((doubt / len(languages) + (1 - doubt) * (c == classes[i])) * math.log(p[c]) for c in range(len(languages)))
        return total

    model = G.fitted(docs, s)
    assert model.languages == languages and np.allclose(model.idf, idf)
    assert np.allclose(model.weights, [[weight(c, i) for i in range(s.dims + 1)] for c in range(len(languages))], atol=1e-5)
    assert loss(model.temperature) <= min(loss(model.temperature * f) for f in (0.9, 0.99, 1.01, 1.1)) + 1e-9
    got = {r["doc_id"]: r for r in G.identified(docs, model).collect()}
    for r in rows:
        p = plain_softmax([x / model.temperature for x in logits(plain_features(r["text"], idf, s.dims))])
        assert got[r["doc_id"]]["lang_pred"] == languages[p.index(max(p))] and got[r["doc_id"]]["score"] == pytest.approx(max(p), abs=1e-4)
