"""SimHash near-duplicates by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm.common import components, kept, packed, small_batches, unpacked

BITS = 64
BUDGET = 3
SHINGLE = 3
SEED = 42
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16
#: Fingerprints that a bucket should hold on average, and beyond which it is split.
BUCKET, LARGE_BUCKET = 64, 100_000
#: Fingerprints and node pairs that a task works on at once.
GROUPED, FRONTIER = 200_000, 1 << 18
#: Row numbers up to this many are broadcast: 8 MB.
BROADCAST_ROWS = 1_000_000


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text: a bit is 1 if it is in over half of the shingles' hashes.

    Words are runs of non-space characters with A-Z in lower case; a text of fewer words is one shingle, one without words has 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    width = min(shingle, len(words))
    begins = (ends - lengths)[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for at in range(0, len(begins), COUNTED):
        hashes = b"".join([digest(joined[b:e], SEED) for b, e in zip(begins[at : at + COUNTED], ends[at : at + COUNTED], strict=True)])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(begins)).tobytes(), "big")


def fingerprinted(docs: DataFrame, shingle: int = SHINGLE, with_text: bool = True) -> DataFrame:
    """The columns of `docs` as `row` (see `packed`; `text` beside it if asked for), with fingerprint (its 64 bits as a bigint)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(0)
            values = [text_fingerprint(texts[i].as_py(), shingle) for i in range(len(texts))]
            prints = pa.array(np.array(values, np.uint64).view(np.int64))
            names = ["text", "row", "fingerprint"][0 if with_text else 1 :]
            yield pa.RecordBatch.from_arrays([*batch.columns, prints][-len(names) :], names=names)

    rows = packed(docs)
    fields = rows.schema.fields[0 if with_text else 1 :]
    return rows.mapInArrow(hashed, T.StructType([*fields, T.StructField("fingerprint", T.LongType())]))


def hex_fingerprint(column: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


# --- trie join -----------------------------------------------------------------------------------


class _Tries:
    """Tries over sorted runs of distinct fingerprints; finds which fingerprints are linked, in `label`.

    A node is a range of the sorted array at a depth. Node pairs descend together: like children keep their number of differing
    bits, unlike ones add one, and a pair beyond the budget is dropped. Two single fingerprints are compared at once. A pair all
    of whose fingerprints are already in one component is dropped, too, as its links would join nothing.
    """

    def __init__(self, values: np.ndarray, budget: int):
        self.values, self.budget = values, budget
        self.label = np.arange(len(values))
        self.same = np.zeros(len(values) + 1, np.int64)  # changes of label up to a place
        self.ones: dict[int, np.ndarray] = {}
        self._count_changes()

    def _count_changes(self) -> None:
        self.same[1 : len(self.label)] = np.cumsum(self.label[1:] != self.label[:-1])

    def _ones(self, depth: int) -> np.ndarray:
        if depth not in self.ones:
            bit = (self.values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            self.ones[depth] = np.concatenate([[0], np.cumsum(bit)]).astype(np.int32)
        return self.ones[depth]

    def join(self, pairs: np.ndarray, depth: int) -> None:
        """`pairs`: rows of (first node's begin and end, second's, differing bits), all at `depth`."""
        waiting = [(depth, pairs)]
        while waiting:
            depth, pairs = waiting.pop()
            pairs = self._open(pairs)
            if not len(pairs):
                continue
            if len(pairs) > FRONTIER:
                half = len(pairs) // 2
                waiting += [(depth, pairs[half:]), (depth, pairs[:half])]
                continue
            waiting.append((depth + 1, self._children(pairs, depth)))

    def _open(self, pairs: np.ndarray) -> np.ndarray:
        """Links what can be compared; what is left has to descend."""
        a, a_end, b, b_end, _ = pairs.T
        leaf = (a_end - a == 1) & (b_end - b == 1)
        one, other = a[leaf], b[leaf]
        near = np.bitwise_count(self.values[one] ^ self.values[other]) <= self.budget
        self._link(one[near], other[near])
        pairs = pairs[~leaf]
        a, a_end, b, b_end, _ = pairs.T
        joined = (self.same[a_end - 1] == self.same[a]) & (self.same[b_end - 1] == self.same[b]) & (self.label[a] == self.label[b])
        return pairs[~joined]

    def _link(self, one: np.ndarray, other: np.ndarray) -> None:
        apart = self.label[one] != self.label[other]
        one, other = one[apart], other[apart]
        if not len(one):
            return
        while True:
            low, high = self.label[one], self.label[other]
            if (low == high).all():
                break
            np.minimum.at(self.label, np.maximum(low, high), np.minimum(low, high))
            while (self.label != self.label[self.label]).any():
                self.label = self.label[self.label]
        self._count_changes()

    def _children(self, pairs: np.ndarray, depth: int) -> np.ndarray:
        ones = self._ones(depth)
        a, a_end, b, b_end, bits = pairs.T
        a_mid, b_mid = a_end - (ones[a_end] - ones[a]), b_end - (ones[b_end] - ones[b])
        self_pair = a == b
        out = []
        for a0, a1, b0, b1, more in (
            (a, a_mid, b, b_mid, 0),
            (a_mid, a_end, b_mid, b_end, 0),
            (a, a_mid, b_mid, b_end, 1),
            (a_mid, a_end, b, b_mid, 1),
        ):
            keep = (a1 > a0) & (b1 > b0) & (bits + more <= self.budget)
            if more and a0 is a_mid:
                keep &= ~self_pair  # the same pair the other way round
            if not more:
                keep &= ~(self_pair & (a1 - a0 == 1))
            out.append(np.stack([a0[keep], a1[keep], b0[keep], b1[keep], bits[keep] + more], axis=1))
        return np.concatenate(out)


def _linked(groups: np.ndarray, values: np.ndarray, depths: np.ndarray, splits: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of fingerprints and of their components' first ones, over sorted runs of equal `groups`.

    A run is joined with itself, or, if its `splits` names two different nodes of a split bucket, the one with the other.
    """
    begins = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    ends = np.concatenate([begins[1:], [len(groups)]])
    tries = _Tries(values, budget)
    low, high = splits >> 32, splits & 0xFFFFFFFF
    for depth in np.unique(depths[begins]):
        of = (depths[begins] == depth) & (ends - begins > 1)
        whole = of & (low[begins] == high[begins])
        rows = np.stack([begins, ends, begins, ends, np.zeros_like(begins)], axis=1)[whole]
        cross = []
        for begin, end in zip(begins[of & ~whole], ends[of & ~whole], strict=True):
            node = values[begin:end] >> np.uint64(BITS - depth)
            middle = begin + int(np.searchsorted(node, node[-1]))
            if begin < middle:
                bits = int(low[begin] ^ high[begin]).bit_count()
                cross.append((begin, middle, middle, end, bits))
        pairs = np.concatenate([rows, np.array(cross, np.int64).reshape(-1, 5)])
        tries.join(pairs, int(depth))
    own = np.flatnonzero(tries.label != np.arange(len(values)))
    return own, tries.label[own]


def _orders(blocks: int, budget: int) -> list[list[tuple[int, int]]]:
    """(shift, width) of the blocks in each order that puts another choice of blocks - budget of them first."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    spans = [(BITS - edges[i + 1], edges[i + 1] - edges[i]) for i in range(blocks)]
    lead = blocks - budget
    return [[spans[i] for i in c] + [s for i, s in enumerate(spans) if i not in c] for c in combinations(range(blocks), lead)]


def _rearranged(value: Column, spans: list[tuple[int, int]]) -> Column:
    out, at = F.lit(0).cast("bigint"), BITS
    for shift, width in spans:
        at -= width
        part = F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
        out = out.bitwiseOR(F.shiftleft(part, at))
    return out


def linked_fingerprints(prints: DataFrame, rows: int, budget: int = BUDGET, large: int = LARGE_BUCKET) -> DataFrame:
    """a, b: links that join the same components as all pairs of `prints` (distinct `fingerprint`) with at most `budget`
    differing bits. `rows`: how many there are.

    Of any budget + k blocks of bits, two such fingerprints agree in k. So each choice of k blocks puts those first, what agrees
    in them is a bucket, and each bucket's trie is joined with itself over the other bits. k is the least for which a bucket
    holds few fingerprints on average. A bucket that still is too large is split by its next bits into nodes, and each pair of
    nodes within the budget is a group of its own. Groups give a spanning forest of their links, so no fingerprint is in more
    links than it has neighbours in it, and output grows with the fingerprints only.
    """
    blocks = next(
        (b for b in range(budget + 1, budget + 5) if rows >> (BITS * (b - budget) // b) <= BUCKET), budget + 4
    )
    orders = _orders(blocks, budget)
    lead = [sum(w for _, w in spans[: blocks - budget]) for spans in orders]
    each = F.explode(
        F.array(
            *(
                F.struct(F.lit(i).alias("order"), F.lit(d).alias("depth"), _rearranged(F.col("fingerprint"), s).alias("value"))
                for i, (s, d) in enumerate(zip(orders, lead, strict=True))
            )
        )
    )
    placed = prints.select("fingerprint", each.alias("p")).select("fingerprint", "p.*")
    placed = placed.withColumn("bucket", F.expr("shiftrightunsigned(value, 64 - depth)"))
    sizes = placed.groupBy("order", "bucket").count().filter(F.col("count") > large)
    sizes = kept(sizes, "large-buckets")
    if sizes.isEmpty():
        split = placed.withColumn("nodes", F.lit(0).cast("bigint"))
    else:
        # each bit halves a bucket where its fingerprints are spread; two more, as they may not be
        more = F.least(F.ceil(F.log2(F.col("count") / large)) + 2, F.lit(12)).cast("int")
        sizes = sizes.select("order", "bucket", more.alias("more"))
        masks = {m: [x for x in range(1 << m) if x.bit_count() <= budget] for m in range(1, 13)}
        table = F.create_map(*(x for m, v in masks.items() for x in (F.lit(m), F.array(*map(F.lit, v)))))
        node = F.expr("shiftrightunsigned(value, 64 - depth - more) & (shiftleft(1L, more) - 1)")
        joined = placed.join(sizes, ["order", "bucket"], "left").withColumn("node", F.coalesce(node, F.lit(0).cast("bigint")))
        near = joined.withColumn("mask", F.explode(F.coalesce(table[F.col("more")], F.array(F.lit(0)))))
        split = near.withColumn("other", F.col("node").bitwiseXOR(F.col("mask").cast("bigint"))).select(
            "order",
            "bucket",
            "fingerprint",
            "value",
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.shiftleft(F.least("node", "other"), 32).bitwiseOR(F.greatest("node", "other")).alias("nodes"),
        )
    group = F.xxhash64("order", "bucket", "nodes").alias("group")
    sorted_ = (
        split.select("order", "bucket", "nodes", "depth", "value", "fingerprint", group)
        .repartition("group")
        .sortWithinPartitions("group", "order", "bucket", "nodes", "value")
    )

    def joined_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        count = 0

        def links(columns, upto):
            order, bucket, nodes, depth, value, fingerprint = (c[:upto] for c in columns)
            key = np.zeros(upto, np.int64)
            change = (order[1:] != order[:-1]) | (bucket[1:] != bucket[:-1]) | (nodes[1:] != nodes[:-1])
            key[1:] = np.cumsum(change)
            own, root = _linked(key, value.view(np.uint64), depth, nodes, budget)
            return pa.RecordBatch.from_arrays([pa.array(fingerprint[own]), pa.array(fingerprint[root])], names=["a", "b"])

        for batch in batches:
            held.append([batch.column(n).to_numpy(zero_copy_only=False) for n in ("order", "bucket", "nodes", "depth", "value", "fingerprint")])
            count += batch.num_rows
            if count >= GROUPED:
                columns = [np.concatenate(c) for c in zip(*held, strict=True)]
                last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
                upto = int(np.argmax(last))  # the last group may go on in the next batch
                if upto:
                    yield links(columns, upto)
                held, count = [[c[upto:] for c in columns]], len(last) - upto
        if count:
            yield links([np.concatenate(c) for c in zip(*held, strict=True)], count)

    return sorted_.drop("group").mapInArrow(joined_tries, "a bigint, b bigint")


def _classes(rows: DataFrame, budget: int) -> DataFrame:
    """component_id of each distinct fingerprint of `rows` (doc_id, fingerprint)."""
    prints = kept(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    links = linked_fingerprints(prints, prints.count(), budget)
    roots = components(links).withColumnRenamed("node", "fingerprint")
    known = kept(prints.join(roots, "fingerprint"), "linked-fingerprints")
    least = known.groupBy("root").agg(F.min("first").alias("least"))
    linked = known.join(least, "root").select("fingerprint", "least")
    return prints.join(linked, "fingerprint", "left").select("fingerprint", F.coalesce("least", "first").alias("component_id"))


def grouped(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """doc_id, fingerprint (bigint) and component_id of every row of `docs` (doc_id, text).

    Fingerprints link at `budget` or fewer differing bits; component_id is the smallest doc_id that links reach, the row's own
    included. Null and empty texts have fingerprint 0 and link like any other. Rows repeated or with one doc_id each have their
    row. A null doc_id counts only where a component has no other, and gives null there. Of other columns nothing is read. An
    empty table gives no rows.

    Texts are read once. All that follows works on distinct fingerprints: equal ones are counted first, so thousands of
    copies are one row; and where copies get their class back, two numbers a row are shuffled, which Spark may split.
    """
    rows = fingerprinted(docs.select("doc_id", "text"), shingle, with_text=False)
    rows = kept(rows.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "fingerprint"), "fingerprints")
    return rows.join(_classes(rows, budget), "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_each(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """`docs` with one row per component: that of the smallest doc_id, of several such rows the first as they were written.

    Rows without doc_id stay only where a component has no other. The texts are kept in the shared folder with their
    fingerprints; up to BROADCAST_ROWS numbers of the rows that go are broadcast, more are joined.
    """
    rows = fingerprinted(docs, shingle).withColumns(
        {"doc_id": F.col("row.doc_id").cast("bigint"), "number": F.monotonically_increasing_id()}
    )
    rows = kept(rows, "fingerprinted-rows")
    small = rows.select("number", "doc_id", "fingerprint").join(_classes(rows, budget), "fingerprint")
    small = kept(small, "row-classes")
    own = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fingerprint "), F.col("fingerprint")))
    stay = F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.col("number")))
    small = small.withColumn("class", own)
    first = small.groupBy("class").agg(stay.alias("number")).select("number")
    # by number, which is a row's own: the rows of one class never meet
    gone = kept(small.select("number").join(first, "number", "left_anti"), "copies")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return unpacked(rows.join(gone, "number", "left_anti"), docs.columns)
