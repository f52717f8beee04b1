"""Language identification by sparse multinomial logistic regression on hashed character n-grams."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayer.llm.common import kept

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
#: Code points whose n-grams are counted at once.
COUNTED = 1 << 20


@dataclass(frozen=True)
class Settings:
    """dims: hashed n-grams. sample_rows: labelled rows that the weights are fitted on, shared evenly by the languages (at least
    least_per_language each); statistics come from all rows. The rest: follow-the-regularised-leader's rates, elastic net, passes."""

    dims: int = 1 << 14
    sample_rows: int = 4_000
    least_per_language: int = 50
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-3
    epochs: int = 3
    seed: int = 11


def ngram_counts(text: str, dims: int) -> np.ndarray:
    """Counts of a whole text's hashed n-grams of one to three characters, in lower case, runs of other than letters as one blank."""
    counts = np.zeros(dims, np.int64)
    text = text.lower()
    for at in range(0, len(text), COUNTED):
        points = np.frombuffer(text[max(0, at - 2) : at + COUNTED].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        letter = ((points >= 97) & (points <= 122)) | ((points >= 0xC0) & (points != 0xD7) & (points != 0xF7) & ~((points >= 0x2000) & (points < 0x2E80)))
        points = np.where(letter, points, np.uint64(32))
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] = True
        points = points[keep]
        grams = points
        for n in (1, 2, 3):
            if n > 1:
                grams = grams[:-1] * np.uint64(0x100000001B3) + points[n - 1 :]
            mixed = (grams + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount(((mixed >> np.uint64(40)) % np.uint64(dims)).astype(np.int64), minlength=dims)
    return counts


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features, of length 1; the last place is the constant."""
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    norm = math.sqrt(float(values @ values)) or 1.0
    return np.append(at, len(idf)), np.append(values / norm, 1.0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, n_classes: int, dims: int, s: Settings) -> np.ndarray:
    """Weights (n_classes, dims) by follow-the-regularised-leader, in `epochs` passes in seeded orders.

    Each weight has its own rate; those whose summed gradients stay within l1 are exactly zero.
    """
    z, n = np.zeros((n_classes, dims)), np.zeros((n_classes, dims))

    def weights(z, n):
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)

    order = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for i in order.permutation(len(rows)):
            at, values = rows[i]
            w = weights(z[:, at], n[:, at])
            error = _softmax(w @ values)
            error[classes[i]] -= 1
            gradient = error[:, None] * values
            more = n[:, at] + gradient**2
            z[:, at] += gradient - (np.sqrt(more) - np.sqrt(n[:, at])) / s.alpha * w
            n[:, at] = more
    return weights(z, n)


def temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The divisor of logits at which held-back rows have the least log loss, by golden section over its logarithm.

    Rows count as one row of doubt short of certain (in n rows, 1 / (n + 2) goes to all classes evenly), so that a model without
    errors on them is not certain either.
    """
    if not len(classes):
        return 1.0
    doubt = 1 / (len(classes) + 2)
    target = np.full(logits.shape, doubt / logits.shape[1])
    target[np.arange(len(classes)), classes] += 1 - doubt

    def loss(log_t: float) -> float:
        return float(-(target * np.log(np.maximum(_softmax(logits / math.exp(log_t)), 1e-300))).sum(axis=1).mean())

    low, high, ratio = -4.0, 4.0, (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (languages, dims + 1)
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of a whole text and its calibrated probability; `und` and 0 without a letter or anything learned."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        at, values = tfidf(ngram_counts(text, len(self.idf)), self.idf)
        p = _softmax(self.weights[:, at] @ values / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def held_out() -> Column:
    """Whether a document is kept from learning: crc32 of its doc_id as text leaves 1 when divided by 3. A null doc_id is learned from."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")), F.lit(3)) == 1


def _document_frequency(rows: DataFrame, dims: int) -> np.ndarray:
    """In how many texts each hashed n-gram occurs; tasks add up their own texts first, `dims` numbers come to the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += ngram_counts(text.as_py(), dims) > 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["at", "n"])

    found = np.zeros(dims, np.int64)
    for row in rows.select("text").mapInArrow(counted, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        found[row["at"]] = row["n"]
    return found


def fitted(docs: DataFrame, s: Settings | None = None) -> Model:
    """A model learned from the rows of `docs` (doc_id, text, lang) that are not held out and have a text and a lang.

    Frequencies of n-grams come from all these rows. The weights are fitted on a sample that is bounded by `Settings`: of each language
    the rows whose doc_id hashes lowest, as many as its share; one task fits them, and a fifth of them sets the temperature.
    """
    s = s or Settings()
    rows = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    per_language = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    languages = sorted(per_language)
    if not languages:
        return Model([], np.ones(s.dims), np.zeros((0, s.dims + 1)), 1.0)
    total = sum(per_language.values())
    idf = np.log((1 + total) / (1 + _document_frequency(rows, s.dims))) + 1
    share = max(s.least_per_language, s.sample_rows // len(languages))
    chance = F.create_map(*(F.lit(x) for c, n in per_language.items() for x in (c, min(1.0, 1.25 * share / n))))
    place = (F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(s.seed)), F.lit(1 << 30)) / float(1 << 30))
    sample = rows.withColumn("place", place).filter(F.col("place") < F.element_at(chance, F.col("lang")))
    # what is left of a language is about its share; repeated rows are bounded here
    ranked = F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))
    sample = kept(sample.withColumn("rank", ranked).filter(F.col("rank") <= share).drop("rank"), "language-sample")
    number = {c: i for i, c in enumerate(languages)}

    def fit(pdf):
        pdf = pdf.sort_values(["place", "lang", "text"])
        features = [tfidf(ngram_counts(t, s.dims), idf) for t in pdf["text"]]
        classes = pdf["lang"].map(number).to_numpy(np.int64)
        back = np.arange(len(pdf)) % 5 == 4
        train = np.flatnonzero(~back)
        weights = fit_ftrl([features[i] for i in train], classes[train], len(languages), s.dims + 1, s)
        logits = np.array([weights[:, features[i][0]] @ features[i][1] for i in np.flatnonzero(back)]).reshape(-1, len(languages))
        return type(pdf)({"weights": [weights.astype("<f4").tobytes()], "temperature": [temperature(logits, classes[back])]})

    one_task = sample.withColumn("task", F.lit(0)).groupBy("task")  # the sample is bounded
    row = one_task.applyInPandas(fit, "weights binary, temperature double").first()
    weights = np.frombuffer(row["weights"], "<f4").reshape(len(languages), s.dims + 1)
    return Model(languages, idf, weights, row["temperature"])


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of `docs` (doc_id, text), from the text alone.

    A text that is null or has no letter is `und` with score 0. Repeated rows get the same answer. Of other columns nothing is
    read. An empty table gives no rows. The model (dims numbers a language) is sent to each worker once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            found = [shared.value.predict(texts[i].as_py()) for i in range(len(texts))]
            languages, scores = pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), languages, scores], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")
