"""Quality rules whose thresholds come from quantile sketches per language and source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayer.llm.common import kept, packed, small_batches, unpacked

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Metric -> numerator (over n_words), its scale, whether its values lie around a middle (rejected on both sides) or trail off from 0.
METRICS = {
    "word_length": ("word_chars", 1_000, True),
    "symbols": ("n_symbols", 100_000, False),
    "dup_lines": ("n_dup_lines", 100_000, False),
    "repeats": ("n_repeat_words", 100_000, False),
}
#: A value around a middle is rejected beyond its group's quartile by more than so many quartile distances.
FENCE = 6
#: Of values that trail off those are rejected that lie beyond the first empty stretch above the median in which values grow so many times.
VALLEY = 4
#: Added to both ends of such a stretch: one occurrence in the 50 words that a judged document has at least, the coarsest step of a rate.
STEP = 100_000 // 50
#: Groups with fewer rows take the thresholds of their language, and languages with fewer those of all rows.
LEAST_ROWS = 50
#: Threshold rows up to this number are broadcast.
BROADCAST_ROWS = 100_000
#: The bound of a metric without one.
UNBOUNDED = (1 << 63) - 1


def _repeat_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # three factors would leave 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:] == ordered[:-1]
    if not twice.any():
        return 0
    at = np.flatnonzero(np.isin(windows, ordered[1:][twice]))
    covered = np.zeros(n, bool)
    for step in range(3):
        covered[at + step] = True
    return int(covered.sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """`STATS` of a whole text; a null has none."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()  # bytes are split at ASCII white space only
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACES):
            seen.add(line)
    chars = len(text) - sum(map(text.count, SPACES))
    return len(words), chars, sum(map(text.count, SYMBOLS)), dup, _repeat_words(words)


def measured(docs: DataFrame, with_text: bool) -> DataFrame:
    """The columns of `docs` as `row` (see `packed`; `text` beside it if asked for), with `STATS` and base_failed."""

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(0)
            values = [text_stats(texts[i].as_py()) for i in range(len(texts))]
            columns = [pa.array([v[i] for v in values], pa.int64()) for i in range(len(STATS))]
            carried = list(zip(("text", "row"), batch.columns, strict=True))[0 if with_text else 1 :]
            names, arrays = zip(*carried, *zip(STATS, columns, strict=True), strict=True)
            yield pa.RecordBatch.from_arrays(list(arrays), names=list(names))

    rows = packed(docs)
    fields = rows.schema.fields[0 if with_text else 1 :]
    schema = T.StructType([*fields, *(T.StructField(s, T.LongType()) for s in STATS)])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.mapInArrow(stats, schema).withColumn("base_failed", failed)


def _metric(name: str) -> Column:
    numerator, scale, _ = METRICS[name]
    return F.expr(f"{numerator} * {scale} div n_words")


def sketched(rows: DataFrame) -> DataFrame:
    """lang, source, metric, bin, n: for each group and metric a histogram whose bins are at most a sixteenth of their value wide.

    Sketches of parts of a group are merged by adding up, in any order, with one result.
    """
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), _metric(m).alias("x")) for m in METRICS)))
    shift = F.greatest(F.length(F.bin("x")) - 5, F.lit(0))
    return (
        rows.filter(~F.col("base_failed"))
        .select("lang", "source", values.alias("v"))
        .select("lang", "source", "v.*")
        .withColumn("shift", shift)
        .groupBy("lang", "source", "metric", F.expr("shift * 32 + shiftright(x, shift)").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source and the bounds of each metric, one row per group of `sketch`.

    All bounds are read off the group's own sketch, or where that has under LEAST_ROWS rows off the merged one of its language,
    or of all. Around a middle they lie FENCE quartile distances beyond the quartiles, each quartile taken at the far edge of its bin.
    Values that trail off from 0, as most documents have none of what is counted, have no spread to go by: there the bound is
    the last value before the first valley above the median, an empty stretch of the sketch over which values grow at least
    VALLEY times. A group whose values trail off without a valley has no such bound.
    """
    nothing = F.lit(None).cast("string")
    levels = (
        sketch.select(F.lit(2).alias("level"), "lang", "source", "metric", "bin", "n")
        .union(sketch.select(F.lit(1), "lang", nothing, "metric", "bin", "n"))
        .union(sketch.select(F.lit(0), nothing, nothing, "metric", "bin", "n"))
        .groupBy("level", "lang", "source", "metric", "bin")
        .agg(F.sum("n").alias("n"))
    )
    group = Window.partitionBy("level", "lang", "source", "metric")
    upward = group.orderBy("bin")
    first = F.expr("shiftleft(bin & 31, int(shiftright(bin, 5)))")
    last = F.expr("shiftleft((bin & 31) + 1, int(shiftright(bin, 5))) - 1")
    below = levels.withColumns(
        {
            "total": F.sum("n").over(group),
            "upto": F.sum("n").over(upward.rowsBetween(Window.unboundedPreceding, 0)),
            "next": F.lead(first).over(upward),
        }
    )
    valley = (F.col("upto") * 2 >= F.col("total")) & (F.col("next") + STEP >= VALLEY * (last + STEP))
    quartiles = below.groupBy("level", "lang", "source", "metric").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), first)).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, last)).alias("q3"),
        F.coalesce(F.min(F.when(valley, last)), F.lit(UNBOUNDED)).alias("end"),
    )
    reach = FENCE * (F.col("q3") - F.col("q1"))
    names, bounds = [], []
    for name, (_, _, centred) in METRICS.items():
        own = F.col("metric") == name
        if centred:
            names.append(f"{name}_least")
            bounds.append(F.max(F.when(own, F.col("q1") - reach)).alias(names[-1]))
        names.append(f"{name}_most")
        bounds.append(F.max(F.when(own, F.col("q3") + reach if centred else F.col("end"))).alias(names[-1]))
    wide = quartiles.groupBy("level", "lang", "source").agg(F.max("total").alias("rows"), *bounds)

    def at(level: int, alias: str) -> DataFrame:
        packed = F.when(F.col("rows") >= LEAST_ROWS, F.struct(*names)).alias(alias)
        return wide.filter(F.col("level") == level).select("lang", "source", packed)

    everyone = wide.filter("level = 0").select(*names).first()  # one row of five numbers
    fallback = F.struct(*(F.lit(everyone[n] if everyone else None).cast("bigint").alias(n) for n in names))
    own, language = at(2, "own").alias("o"), at(1, "language").alias("l")
    joined = own.join(language, F.col("o.lang").eqNullSafe(F.col("l.lang")), "left")
    return joined.select("o.lang", "o.source", F.coalesce("own", "language", fallback).alias("b")).select(
        "lang", "source", "b.*"
    )


def judged(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Rows of `docs` (text, lang, source and others, these as `row`) with `STATS`, base_failed and kept.

    base_failed: fewer than 50 words, or over half of the words in repeated three-word windows. Of the other rows those are kept
    whose word length, symbols, repeated lines and repeated words per word lie within the thresholds of their language and
    source; thresholds come from all rows of the group that are not base_failed. Null languages and sources are groups of their own.
    A null or empty text has no words and is rejected; repeated rows are judged alike; columns of any name stay in `row`.
    An empty table gives no rows.

    Texts are read once; what they gave is kept in the shared folder for the second step. A group's rows meet as a few
    hundred counters, so a hot source is no hot task, and its thresholds reach the rows by a broadcast of one row a group.
    """
    rows = kept(
        measured(docs, with_text).withColumns({"lang": F.col("row.lang"), "source": F.col("row.source")}), "measured"
    )
    bounds = kept(thresholds(kept(sketched(rows), "sketch")), "thresholds").alias("b")
    if bounds.count() <= BROADCAST_ROWS:
        bounds = F.broadcast(bounds)
    same = F.col("r.lang").eqNullSafe(F.col("b.lang")) & F.col("r.source").eqNullSafe(F.col("b.source"))
    fine = ~F.col("base_failed")
    for name, (_, _, centred) in METRICS.items():
        fine &= F.when(F.col("n_words") > 0, _metric(name)) <= F.col(f"{name}_most")
        if centred:
            fine &= F.when(F.col("n_words") > 0, _metric(name)) >= F.col(f"{name}_least")
    carried = ["text", "row"] if with_text else ["row"]
    return rows.alias("r").join(bounds, same, "left").select(
        *carried, *STATS, "base_failed", F.coalesce(fine, F.lit(False)).alias("kept")
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that `judged` keeps."""
    return unpacked(judged(docs).filter("kept"), docs.columns)
