"""Audit of how sources of a language differ in their words; frequent words by iceberg refinement of byte prefixes."""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayer.llm.common import kept, small_batches

#: Terms are runs of ASCII letters and of bytes beyond ASCII, which are whole characters, as those bytes make up nothing else: A-Z in
#: lower case, every other byte a space.
TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LEAST_DOCS = 10
TOP = 10
#: Bytes of the first prefixes; each level doubles them.
FIRST_BYTES = 8
#: Ends a term among its prefixes; no term has that byte.
END = b"\x00"
#: Bits of the filter that says which prefixes stay: 16 MB, whatever the corpus.
FILTER_BITS = 1 << 27
SEED = 42
_BITMAP = 1 << 15
#: Terms of rows that a task gathers in blocks, and the columns of a block.
BLOCK_TERMS = 1 << 21
BLOCK_SCHEMA = (
    "lang string, terms binary, lengths binary, codes binary, counts binary, sources array<string>, source_of binary, "
    "prefixes array<binary>, docs array<bigint>"
)
BLOCK_NAMES = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
BLOCK_TYPES = [pa.string(), *[pa.binary()] * 4, pa.list_(pa.string()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
#: Rows of a batch that a task hands on.
OUT_ROWS = 1 << 16
#: Numbers of a block of terms by sources, and terms of it at most.
CELLS, CHUNK = 1 << 20, 4096


class _Numbers(dict):
    """Numbers of values, as they come."""

    def __missing__(self, value) -> int:
        number = self[value] = len(self)
        return number


class _Gathered:
    """A block of one language as it grows."""

    def __init__(self, lang: str):
        self.lang, self.places = lang, _Numbers()
        self.lengths, self.source_of = array("i"), array("i")
        self.said: list[bytes] = []  # each row's distinct terms, and their occurrences
        self.counts: list[int] = []

    def add(self, text: bytes, source: str) -> int:
        found = Counter(text.translate(TO_TERMS).split())
        self.lengths.append(len(found))
        self.said.extend(found)
        self.counts.extend(found.values())
        self.source_of.append(self.places[source])
        return len(found)

    def out(self) -> pa.RecordBatch:
        terms = sorted(set(self.said))
        place = dict(zip(terms, range(len(terms)), strict=True))
        codes = np.fromiter(map(place.__getitem__, self.said), "<i4", len(self.said))
        lengths = np.array(self.lengths, "<i4")
        prefixes, of = _stems(terms, FIRST_BYTES)
        docs = _documents(np.repeat(np.arange(len(lengths)), lengths), of[codes], of, len(prefixes))
        numbers = [x.tobytes() for x in (lengths, codes, np.array(self.counts, "<i4"), np.array(self.source_of, "<i4"))]
        row = [self.lang, b" ".join(terms), *numbers[:3], list(self.places), numbers[3], prefixes, docs]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, BLOCK_TYPES, strict=True)], names=BLOCK_NAMES)


def _stems(terms: list[bytes], size: int) -> tuple[list[bytes], np.ndarray]:
    """The distinct beginnings of `size` bytes of sorted terms, with their end marks where that long, and the place of each term's."""
    # fixed-width bytes are padded with the end mark, which no term has
    cut = np.array([t[:size] for t in terms], f"S{size}")
    changes = np.concatenate([[True], cut[1:] != cut[:-1]]) if len(cut) else np.zeros(0, bool)
    own = cut[changes].tolist()  # gives them back without their marks
    return [t if len(t) == size else t + END for t in own], np.cumsum(changes) - 1


def _documents(row: np.ndarray, prefix: np.ndarray, of: np.ndarray, prefixes: int) -> list[int]:
    """For each prefix the rows that have it; a row counts once, however many of its terms begin with it.

    `row` and `prefix` are those of each row's distinct terms, `of` is the prefix of each distinct term. Only where several terms
    share a prefix can a row have it twice.
    """
    docs = np.bincount(prefix, minlength=prefixes)
    several = np.bincount(of, minlength=prefixes) > 1
    shared = several[prefix]
    width = max(1, prefixes)
    once = np.unique(row[shared] * width + prefix[shared]) % width
    docs[several] = np.bincount(once, minlength=prefixes)[several]
    return docs.tolist()


def tokenised(docs: DataFrame) -> DataFrame:
    """Blocks of the rows of `docs` (text, lang, source; nulls are empty texts), each of one language.

    lang; terms (the block's distinct ones in byte order, joined by spaces); lengths (distinct terms of each row), codes and counts
    (place of each in `terms` and its occurrences, row by row); sources and source_of (place of each row's in `sources`); prefixes
    and docs (the first level's, and the rows that have them). Numbers are little-endian, of 32 bits. A task holds up to
    BLOCK_TERMS terms of rows, or one row where that has more.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, _Gathered] = {}
        held = 0
        for batch in small_batches(batches):
            texts = batch.column(0)
            for i, (lang, source) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if lang not in blocks:
                    blocks[lang] = _Gathered(lang)
                held += blocks[lang].add(texts[i].as_py(), source)
            if held >= BLOCK_TERMS:
                while blocks:
                    yield blocks.popitem()[1].out()
                held = 0
        while blocks:
            yield blocks.popitem()[1].out()

    def filled(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    rows = docs.select(filled("text").cast("binary"), filled("lang"), filled("source"))
    return rows.mapInArrow(split, BLOCK_SCHEMA)


@dataclass
class _Block:
    """A row of `tokenised`."""

    lang: str
    terms: list[bytes]
    row: np.ndarray  # of each term of each row
    codes: np.ndarray
    counts: np.ndarray
    sources: list[str]
    source_of: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            lang, terms, lengths, codes, counts, sources, source_of = (c[i].as_py() for c in batch.columns[:7])
            row = np.repeat(np.arange(len(lengths) // 4), np.frombuffer(lengths, "<i4"))
            numbers = (np.frombuffer(x, "<i4") for x in (codes, counts))
            yield _Block(lang, terms.split(b" ") if terms else [], row, *numbers, sources, np.frombuffer(source_of, "<i4"))
    pa.default_memory_pool().release_unused()


def _place(lang: bytes, prefix: bytes) -> int:
    """A prefix's bit in the filter: Spark's xxhash64(lang, prefix), reduced."""
    return xxhash.xxh64_intdigest(prefix, xxhash.xxh64_intdigest(lang, SEED)) & (FILTER_BITS - 1)


class Filter:
    """Which (lang, prefix) may have stayed; says no only to those that have not."""

    def __init__(self, bits: bytearray):
        self.bits = bits

    def __call__(self, lang: bytes, prefix: bytes) -> bool:
        place = _place(lang, prefix)
        return bool(self.bits[place >> 3] >> (place & 7) & 1)

    @classmethod
    def of(cls, stayed: DataFrame) -> Filter:
        """From rows (lang, prefix). The bits are set by Spark; at most FILTER_BITS of them come to the driver."""
        place = F.xxhash64(F.col("lang").cast("binary"), "prefix").bitwiseAND(F.lit(FILTER_BITS - 1))
        maps = stayed.select(place.alias("place")).groupBy(F.expr(f"place div {_BITMAP}").alias("bucket"))
        maps = maps.agg(F.expr(f"bitmap_construct_agg(place % {_BITMAP})").alias("bits"))
        bits = bytearray(FILTER_BITS // 8)
        for row in maps.toLocalIterator():
            at = row["bucket"] * (_BITMAP // 8)
            bits[at : at + len(row["bits"])] = row["bits"]
        return cls(bits)


def _first_level(rows: DataFrame) -> DataFrame:
    """(lang, prefix, docs) of the shortest prefixes, as the blocks have them."""
    each = F.inline(F.arrays_zip(F.col("prefixes").alias("prefix"), F.col("docs").alias("n")))
    return rows.select("lang", each).toDF("lang", "prefix", "n").groupBy("lang", "prefix").agg(F.sum("n").alias("docs"))


def _next_level(rows: DataFrame, size: int, before: int, filtered) -> DataFrame:
    """(lang, prefix, docs): documents that have a term with that prefix of at most `size` bytes, for terms not settled by level
    `before` whose prefix of that many bytes has stayed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stays = Filter(filtered.value)
        for block in _blocks(batches):
            long = [i for i, t in enumerate(block.terms) if len(t) >= before]
            stems, of = _stems([block.terms[i] for i in long], before)
            fine = np.fromiter((stays(block.lang.encode(), s) for s in stems), bool, len(stems))
            left = np.array(long, np.int64)[fine[of]] if long else np.zeros(0, np.int64)
            prefixes, of = _stems([block.terms[i] for i in left.tolist()], size)
            prefix_of = np.full(len(block.terms), -1, np.int64)
            prefix_of[left] = of
            prefix = prefix_of[block.codes]
            docs = _documents(block.row[prefix >= 0], prefix[prefix >= 0], of, len(prefixes))
            columns = [pa.repeat(block.lang, len(docs)), pa.array(prefixes, pa.binary()), pa.array(docs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "prefix", "docs"])

    partial = rows.select(*BLOCK_NAMES[:7]).mapInArrow(count, "lang string, prefix binary, docs bigint")
    return partial.groupBy("lang", "prefix").agg(F.sum("docs").alias("docs"))


def frequent_terms(rows: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term): terms that at least `least` documents of their language have; `rows` as `tokenised` gives them.

    Level by level, prefixes of 8, 16, 32, ... bytes are counted by distinct documents and those in fewer than `least` discarded;
    only terms whose prefix has stayed are extended on the next level. A prefix with the end mark is a complete term and settled. What
    has stayed reaches the tasks as a bit filter of fixed size. Where that errs it lets through a prefix that is rare, and so is what
    extends it, which the next count discards: the terms are exact for any corpus.
    """
    spark, settled, size, filtered = rows.sparkSession, [], FIRST_BYTES, None
    counted = _first_level(rows)
    while True:
        stayed = kept(counted.filter(F.col("docs") >= least), "prefixes")
        whole = F.substring(F.hex("prefix"), -2, 2) == "00"
        settled.append(stayed.filter(whole).select("lang", F.expr("substring(prefix, 1, length(prefix) - 1)").cast("string").alias("term")))
        open_ = stayed.filter(~whole)
        if open_.isEmpty():
            break
        if filtered is not None:
            filtered.unpersist()
        filtered = spark.sparkContext.broadcast(bytes(Filter.of(open_).bits))
        counted = _next_level(rows, 2 * size, size, filtered)
        size *= 2
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def term_counts(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, term, n): occurrences of `terms` (lang, term), where there are any. Rare terms are left out by a bit filter
    before anything is shuffled, and what that lets through by the join."""
    whole = terms.select("lang", F.encode("term", "UTF-8").alias("prefix"))
    filtered = rows.sparkSession.sparkContext.broadcast(bytes(Filter.of(whole).bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stays = Filter(filtered.value)
        for block in _blocks(batches):
            lang, width = block.lang.encode(), max(1, len(block.terms))
            fine = np.fromiter((stays(lang, t) for t in block.terms), bool, len(block.terms))
            said = pa.array([block.terms[i].decode() for i in np.flatnonzero(fine).tolist()], pa.string())
            of = fine[block.codes]
            key = block.source_of[block.row[of]].astype(np.int64) * width + (np.cumsum(fine) - 1)[block.codes[of]]
            order = np.argsort(key, kind="stable")
            key, n = key[order], block.counts[of][order].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            each, n = key[first], np.add.reduceat(n, first) if len(key) else n
            for at in range(0, len(each), OUT_ROWS):
                part = each[at : at + OUT_ROWS]
                source, term = pa.array(block.sources).take(pa.array(part // width)), said.take(pa.array(part % width))
                columns = [pa.repeat(block.lang, len(part)), source, term, pa.array(n[at : at + OUT_ROWS])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n"])

    partial = rows.select(*BLOCK_NAMES[:7]).mapInArrow(count, "lang string, source string, term string, n bigint")
    # dealt out at once: a task has few counts of one group and term, so adding them up before would not pay
    summed = partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    return summed.join(terms, ["lang", "term"]).select("lang", "source", "term", "n")


@dataclass
class _Totals:
    """Sources of each language in order, each one's occurrences of kept terms, and how many terms are kept."""

    sources: dict[str, list[str]]
    n: dict[str, list[int]]
    terms: dict[str, int]


def shares(counts, total: int, terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), exactly."""
    counts = np.asarray(counts)
    if total < 1 << 33:
        return 1 + 1_000_000_000 * (counts.astype(np.int64) + 2) // (total + 2 * terms)
    exact = [1 + 1_000_000_000 * (c + 2) // (total + 2 * terms) for c in counts.ravel().tolist()]
    return np.array(exact, np.int64).reshape(counts.shape)


class _Best:
    """For each source of a language the `top` terms of the largest values, of equal ones the first in byte order; terms come in that order."""

    def __init__(self, sources: int, top: int):
        self.top, self.values, self.terms = top, [np.zeros(0, np.int64)] * sources, [np.zeros(0, object)] * sources
        self.least = np.full(sources, -1, np.int64)  # only what is larger can still come in

    def add(self, terms: np.ndarray, value: np.ndarray) -> None:
        """`value` has a row per term and a column per source; below 0 is none."""
        row, column = np.nonzero(value > self.least)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        ends = np.flatnonzero(np.concatenate([column[1:] != column[:-1], [True]])) + 1 if len(column) else []
        begin = 0
        for end in ends:
            k, own = column[begin], row[begin:end]
            values = np.concatenate([self.values[k], value[own, k]])
            first = np.argsort(-values, kind="stable")[: self.top]
            self.values[k], self.terms[k] = values[first], np.concatenate([self.terms[k], terms[own]])[first]
            if len(first) == self.top:
                self.least[k] = self.values[k][-1]
            begin = end


def _divergences(counts: DataFrame, totals: _Totals, top: int) -> DataFrame:
    """(lang, one, other, term, value), parts that tasks have added up.

    For numbers one < other of a language's sources the sum of (p - q)^2 div (p + q) over the task's terms, without `term`; and without
    `other` the `top` of the task's terms that source `one` has more often than its language. All counts of a term meet as one row of a
    matrix of terms by sources, at most as long as there are sources; a task hands on one row per pair of sources and `top` per source.
    """
    said = counts.sparkSession.sparkContext.broadcast(totals)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: _Totals = said.value
        place = {lang: {s: i for i, s in enumerate(names)} for lang, names in t.sources.items()}
        sums: dict[str, np.ndarray] = {}
        best: dict[str, _Best] = {}
        lang, rows, at, terms, last = None, [], [], [], None

        def closed() -> None:
            if not rows:
                return
            names = t.sources[lang]
            n = np.zeros((len(terms), len(names)), np.int64)
            i, j = np.array(at).T
            n[i, j] = rows
            p = np.stack([shares(n[:, k], t.n[lang][k], t.terms[lang]) for k in range(len(names))], axis=1)
            total = sums.setdefault(lang, np.zeros((len(names), len(names)), np.int64))
            for k in range(len(names) - 1):
                q = p[:, k : k + 1]
                total[k, k + 1 :] += ((p[:, k + 1 :] - q) ** 2 // (p[:, k + 1 :] + q)).sum(axis=0)
            q = shares(n.sum(axis=1), sum(t.n[lang]), t.terms[lang])[:, None]
            more = np.where((n > 0) & (p > q), (p - q) ** 2 // (p + q), -1)
            best.setdefault(lang, _Best(len(names), top)).add(np.array(terms, object), more)
            rows.clear()
            at.clear()
            terms.clear()

        for batch in batches:
            for new, source, term, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if new != lang or term != last:
                    if new != lang or len(terms) >= max(1, min(CHUNK, CELLS // len(t.sources[lang]))):
                        closed()
                        lang = new
                    last = term
                    terms.append(term)
                at.append((len(terms) - 1, place[lang][source]))
                rows.append(n)
        closed()
        types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
        for lang, total in sums.items():
            for k in range(len(total)):
                other, own = np.arange(k + 1, len(total)), best[lang]
                size = len(other) + len(own.terms[k])
                others, words = [*other.tolist(), *[None] * len(own.terms[k])], [*[None] * len(other), *own.terms[k]]
                columns = [[lang] * size, [k] * size, others, words, [*total[k, k + 1 :].tolist(), *own.values[k].tolist()]]
                arrays = [pa.array(c, x) for c, x in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "one", "other", "term", "value"])

    dealt = counts.select("lang", "source", "term", "n").repartition("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInArrow(add_up, "lang string, one int, other int, term string, value bigint")


def audited(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value (long), rank (int, from 1 per group and part): how sources of a language differ.

    Part `pair`: each other source of the language with the divergence of the two over all kept terms, all ranks. Part `term`: the
    `top` terms that the source has more often than its language. Kept are the terms of at least `least` documents of the language; p
    is a group's share of a term in thousand millionths, with two occurrences added for each, q the other's, and each term's divergence
    (p - q)^2 div (p + q). Null text, lang and source are empty ones. Repeated rows are documents of their own. Every group has its
    pairs, with or without terms; one alone in its language has none. Ties go by the item's bytes. Other columns are not
    read; an empty table gives no rows.

    Texts are read once; the distinct terms of the documents are kept in the shared folder, in blocks, for the levels. Everything is counted
    within tasks before it is shuffled, so a hot source or word is one row per task. The driver gets a row per group, the
    square root of the result.
    """
    rows = kept(tokenised(docs), "terms", "zstd")
    groups = rows.select("lang", F.explode("sources").alias("source")).distinct()
    terms = kept(frequent_terms(rows, least), "frequent-terms")
    counts = kept(term_counts(rows, terms), "term-counts")
    sizes = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
    vocabulary = {r["lang"]: r["count"] for r in terms.groupBy("lang").count().collect()}
    totals = _Totals({}, {}, vocabulary)
    for r in sorted(sizes.collect(), key=lambda r: (r["lang"].encode(), r["source"].encode())):
        totals.sources.setdefault(r["lang"], []).append(r["source"])
        totals.n.setdefault(r["lang"], []).append(r["n"] or 0)

    spark = docs.sparkSession
    listed = [(lang, s, i, n) for lang, names in totals.sources.items() for i, (s, n) in enumerate(zip(names, totals.n[lang], strict=True))]
    listed = spark.createDataFrame(listed, "lang string, source string, place int, n bigint")
    a, b = listed.alias("a"), listed.alias("b")
    differ = (F.col("a.lang") == F.col("b.lang")) & (F.col("a.place") != F.col("b.place"))
    both = a.join(b, differ).select(
        F.col("a.lang").alias("lang"),
        F.col("a.source").alias("source"),
        F.col("b.source").alias("item"),
        F.least("a.place", "b.place").alias("one"),
        F.greatest("a.place", "b.place").alias("other"),
    )
    parts = kept(_divergences(counts, totals, top), "divergences")
    summed = parts.filter("term IS NULL").groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
    both = both.join(summed, ["lang", "one", "other"], "left")
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(group))

    own = listed.select("lang", "source", F.col("place").alias("one"))
    best = parts.filter("term IS NOT NULL").join(own, ["lang", "one"])
    best = best.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    best = best.withColumn("rank", F.row_number().over(group)).filter(F.col("rank") <= top)
    return pairs.unionByName(best)
