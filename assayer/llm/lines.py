"""Line deduplication through a sharded minimal perfect hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm.common import kept, packed, small_batches, unpacked

STRIP = b" \t\n\x0b\x0c\r"
#: Keys that one shard of the hash holds on average.
SHARD_KEYS = 100_000
#: Arrays up to this size go to every task; larger ones stay apart and the lines come to them.
BROADCAST_BYTES = 64 << 20
#: Line hashes that probe a shard in one task, where lines come to the shards.
GROUP_LINES = 500_000
#: Bytes of a key's slot, and a bound of what the hash itself takes for it.
SLOT_BYTES = 8 + 4 + 8 + 1
_STEP = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: multiply and xor-shift."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys: cascaded bit arrays.

    On each level a key hashes to a bit; bits that one key alone hits are set and settle that key, the others go to the next
    level. A key's index is the number of set bits before its own. About 3 bits per key; `levels` are packed bits.
    """

    GAMMA = 2.0

    def __init__(self, levels: list[tuple[int, np.ndarray]]):
        self.levels = levels
        self.ranks, total = [], 0
        for _, words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(total + np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(ones) else ones)
            total += int(ones.sum())

    @staticmethod
    def _bit(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * _STEP % (1 << 64))
        return _mixed(_mixed(high + seed) ^ low) % np.uint64(size)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        levels = []
        while len(high):
            size = max(64, -(-int(len(high) * cls.GAMMA) // 64) * 64)
            at = cls._bit(high, low, len(levels), size)
            hits = np.bincount(at.astype(np.int64), minlength=size)
            packed = np.packbits(hits == 1, bitorder="little").view("<u8")
            levels.append((size, packed))
            left = hits[at.astype(np.int64)] != 1
            high, low = high[left], low[left]
        return cls(levels)

    def index(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Each key's index; for a key that was not built in, any index or -1."""
        found = np.full(len(high), -1, np.int64)
        open_ = np.arange(len(high))
        for level, ((size, words), ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            if not len(open_):
                break
            at = self._bit(high[open_], low[open_], level, size).astype(np.int64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            found[open_[hit]] = ranks[word[hit]] + below[hit]
            open_ = open_[~hit]
        return found


def _keys(text: str | None, least: int) -> tuple[list[str], list[int], list[bytes]]:
    """A text's lines, and for lines whose key is long enough their places and 128-bit key hashes."""
    lines = (text or "").split("\n")
    places, hashes = [], []
    for i, line in enumerate(lines):
        if len(line) >= least:
            key = line.encode("utf-8", "surrogatepass").strip(STRIP).lower()
            if len(key) >= least and len(key.decode("utf-8", "surrogatepass")) >= least:
                places.append(i)
                hashes.append(xxhash.xxh3_128_digest(key))
    return lines, places, hashes


def _halves(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(hashes), ">u8").astype(np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def key_counts(docs: DataFrame, least_chars: int) -> DataFrame:
    """high, low, n (distinct documents), owner (largest doc_id) of each line key of at least `least_chars` code points.

    Repeats within a document are dropped before the shuffle; a line that most documents have is first counted by doc_id.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            ids, hashes = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = set(_keys(text, least_chars)[2])
                ids += [doc_id] * len(own)
                hashes += own
            high, low = _halves(hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(high.view(np.int64)), pa.array(low.view(np.int64))],
                names=["doc_id", "high", "low"],
            )

    hashed = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(found, "doc_id bigint, high bigint, low bigint")
    return (
        hashed.distinct()
        .groupBy("high", "low")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("owner"))
    )


def shard_arrays(counts: DataFrame, shards: int) -> DataFrame:
    """shard, bits (the hash's levels), prints, counts, owners, ownerless of the keys in `counts`, one row per shard.

    Shards are dealt by the key's high half, so each has about the same number of keys whatever the lines are.
    """

    def built(pdf):
        high, low = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("high", "low"))
        hash_ = PerfectHash.build(high, low)
        at = hash_.index(high, low)
        prints, n, owners, none = (np.zeros(len(pdf), t) for t in ("<u8", "<u4", "<i8", "u1"))
        prints[at] = _mixed(high) ^ low
        n[at] = np.minimum(pdf["n"], 2**32 - 1)
        owners[at], none[at] = pdf["owner"].fillna(0), pdf["owner"].isna()
        sizes = np.array([len(hash_.levels), *(size for size, _ in hash_.levels)], "<u8")
        bits = np.concatenate([sizes, *(words for _, words in hash_.levels)])
        row = [int(pdf["shard"].iloc[0]), bits, prints, n, owners, none]
        return type(pdf)([[v if isinstance(v, int) else v.tobytes() for v in row]], columns=fields)

    fields = ["shard", "bits", "prints", "counts", "owners", "ownerless"]
    dealt = counts.withColumn("shard", F.pmod(F.shiftright("high", 20), F.lit(shards)).cast("int"))
    schema = "shard int, " + ", ".join(f"{f} binary" for f in fields[1:])
    return dealt.groupBy("shard").applyInPandas(built, schema)


class Shard:
    """The arrays of one shard, ready to be probed."""

    def __init__(self, row):
        bits = np.frombuffer(row["bits"], "<u8")
        sizes, levels, at = bits[1 : 1 + int(bits[0])], [], 1 + int(bits[0])
        for size in sizes:
            levels.append((int(size), bits[at : at + int(size) // 64]))
            at += int(size) // 64
        self.hash = PerfectHash(levels)
        self.prints, self.counts = np.frombuffer(row["prints"], "<u8"), np.frombuffer(row["counts"], "<u4")
        self.owners, self.none = np.frombuffer(row["owners"], "<i8"), np.frombuffer(row["ownerless"], "u1")

    def repeated(self, high: np.ndarray, low: np.ndarray, doc: np.ndarray, known: np.ndarray, least: int) -> np.ndarray:
        """Whether a line goes: its key is here with at least `least` documents and its document is not the owner."""
        at = self.hash.index(high, low)
        here = at >= 0
        here[here] = self.prints[at[here]] == (_mixed(high) ^ low)[here]
        slot = np.where(here, at, 0)
        owner = np.where(self.none[slot] == 1, ~known, known & (self.owners[slot] == doc))
        return here & (self.counts[slot] >= least) & ~owner


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


def deduplicated(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (of the lines that stay) and row (the columns beside text) of every row of `docs`.

    A line's key is the line without white space at its ends, in lower case (A-Z only). Keys of at least `least_chars` code
    points found in at least `least_docs` documents lose all their lines except in the largest doc_id that has them; there all
    stay. A null or empty text is one empty line and stays as it is (a null gives the text ''). Rows with one doc_id are one
    document; rows without doc_id are one document too, which owns a line only if no other has it. Columns beside doc_id and
    text are kept in `row` whatever their names. An empty table gives no rows.

    Two passes over the texts; only 24 bytes per distinct line and document are shuffled, never a text (but see below). Of
    the counted keys those with enough documents make the arrays. If they fit `broadcast_bytes` they go to all tasks, and
    documents probe them there. If not, the lines' hashes are dealt to the shards, probed there, and the few that hit
    come back by doc_id.
    """
    spark = docs.sparkSession
    counts = kept(key_counts(docs, least_chars).filter(F.col("n") >= least_docs), "line-counts")
    keys = counts.count()
    shards = max(1, -(-keys // SHARD_KEYS))
    arrays = kept(shard_arrays(counts, shards), "line-arrays")
    rows = packed(docs)
    row_field = rows.schema["row"]
    rows = rows.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "text", "row")
    if keys * SLOT_BYTES <= broadcast_bytes:
        hashes = spark.sparkContext.broadcast({r["shard"]: r.asDict() for r in arrays.collect()})

        def repeated(high, low, doc, known):
            return _probe(lambda s: hashes.value.get(s), shards, high, low, doc, known, least_docs)

        marked = rows.withColumn("drops", F.lit(None).cast("array<binary>"))
    else:
        repeated = None
        drops = _probed_in_shards(docs, arrays, shards, least_chars, least_docs)
        marked = rows.alias("d").join(drops.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")), "left")
        marked = marked.select("d.*", "h.drops")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, split = batch.column(1).to_pylist(), []
            for text in texts:
                split.append(_keys(text, least_chars))
            if repeated is None:
                drops = batch.column(3).to_pylist()
                gone = [{p for p, h in zip(s[1], s[2], strict=True) if h in set(d or ())} for s, d in zip(split, drops, strict=True)]
            else:
                high, low = _halves([h for s in split for h in s[2]])
                doc, known = _ids(batch.column(0))
                each = np.repeat(np.arange(len(split)), [len(s[2]) for s in split])
                hit = repeated(high, low, doc[each], known[each])
                places = np.array([p for s in split for p in s[1]], np.int64)
                gone = [set() for _ in split]
                for i in np.flatnonzero(hit):
                    gone[each[i]].add(places[i])
            texts = ["\n".join(x for i, x in enumerate(s[0]) if i not in g) if g else "\n".join(s[0]) for s, g in zip(split, gone, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s[0]) for s in split], pa.int64()),
                    pa.array([len(g) for g in gone], pa.int64()),
                    pa.array(texts, pa.string()),
                    batch.column(2),
                ],
                names=["doc_id", "n_lines", "n_dropped", "text", "row"],
            )

    fields = [T.StructField(n, T.LongType()) for n in ("doc_id", "n_lines", "n_dropped")]
    return marked.mapInArrow(cut, T.StructType([*fields, T.StructField("text", T.StringType()), row_field]))


def _probe(shard_row, shards: int, high, low, doc, known, least: int) -> np.ndarray:
    """Lines probe the shard of their key; each shard's arrays are unpacked once per worker."""
    hit = np.zeros(len(high), bool)
    of = (high.view(np.int64) >> np.int64(20)) % np.int64(shards)
    for shard in np.unique(of):
        if (row := shard_row(int(shard))) is None:
            continue
        if "ready" not in row:
            row["ready"] = Shard(row)
        own = np.flatnonzero(of == shard)
        hit[own] = row["ready"].repeated(high[own], low[own], doc[own], known[own], least)
    return hit


def _probed_in_shards(docs: DataFrame, arrays: DataFrame, shards: int, least_chars: int, least_docs: int) -> DataFrame:
    """doc_id, drops (key hashes whose lines go): lines are dealt over pieces of the shards and probe the arrays there.

    Each document's distinct hashes are kept first. The shard with most of them says over how many tasks the lines of a shard
    are dealt, each with a copy of its arrays (by doc_id and hash, so that neither a very common line nor the rows without doc_id
    are a task of their own): about GROUP_LINES come to one, whatever the corpus.
    """

    def hashed(batches):
        for batch in small_batches(batches):
            ids, hashes = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = set(_keys(text, least_chars)[2])
                ids += [doc_id] * len(own)
                hashes += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.binary())], names=["doc_id", "hash"])

    def probed(key, lines, tables):
        import pandas as pd

        if not len(lines) or not len(tables):
            return pd.DataFrame({"doc_id": pd.Series(dtype="Int64"), "hash": pd.Series(dtype=object)})
        shard = Shard(tables.iloc[0])
        high, low = _halves(list(lines["hash"]))
        doc, known = lines["doc_id"].fillna(0).to_numpy(np.int64), lines["doc_id"].notna().to_numpy()
        return lines.loc[shard.repeated(high, low, doc, known, least_docs), ["doc_id", "hash"]]

    high = F.conv(F.hex(F.substring("hash", 1, 8)), 16, -10).cast("bigint")
    lines = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(hashed, "doc_id bigint, hash binary")
    shard = F.pmod(F.shiftright(high, 20), F.lit(shards)).cast("int").alias("shard")
    lines = kept(lines.distinct().select("doc_id", "hash", shard), "line-hashes")
    most = lines.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    salts = max(1, -(-most // GROUP_LINES))
    lines = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id", "hash"), F.lit(salts)).cast("int"))
    copies = arrays.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = lines.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInPandas(probed, "doc_id bigint, hash binary")
    return hits.groupBy("doc_id").agg(F.collect_list("hash").alias("drops"))


def digest(result: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of `deduplicated`."""
    return result.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))



def cleaned(docs: DataFrame) -> DataFrame:
    """`docs` with the lines that stay, and n_chars (if there is one) of what is left. A text that loses all its lines is ''."""
    result = unpacked(deduplicated(docs), docs.columns)
    return result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else result
