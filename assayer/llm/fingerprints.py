"""Bottom-k fingerprints of documents: the k least hashes of their distinct word shingles. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import kept, numbered

K = 128
SHINGLE = 5
#: Copies of one row that one task writes.
COPIES_PER_TASK = 100_000
_SPACE = " \t\n\x0b\x0c\r"
_SPACES = r"[ \t\n\x0B\f\r]+"


def words(text: Column) -> Column:
    """The runs of non-space characters of a text; none of an empty one."""
    trimmed = F.btrim(text, F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACES))


def with_sketch(df: DataFrame, text: Column, name: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """`df` with the sketch of `text`: an ascending array of at most k hashes of 63 bits.

    Words are hashed once and a shingle is the hash of its words' hashes. A text of fewer words is one shingle, one without
    words has none. The sketch depends on the set of shingles only: order and repeats in the text do not matter.
    """
    hashed = df.withColumn("_words", F.transform(words(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w)))
    starts = F.slice("_words", F.lit(1), F.greatest(F.size("_words") - (shingle - 1), F.lit(1)))
    shingles = F.transform(
        starts,
        lambda first, i: F.shiftrightunsigned(F.xxhash64(first, *(F.get("_words", i + s) for s in range(1, shingle))), 1),
    )
    return hashed.withColumn(name, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)).drop("_words")


def merged(*sketches: Column, k: int = K) -> Column:
    """The sketch of all shingles of several parts, from the parts' sketches."""
    whole = sketches[0]
    for other in sketches[1:]:
        whole = F.array_union(whole, other)
    return F.slice(F.sort_array(whole), 1, k)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    largest = (F.element_at(sketch, -1).cast("double") + 1) / float(1 << 63)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / largest)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated shared part of the union of two shingle sets; exact where that has at most k. Two empty sets are alike."""
    both = merged(a, b, k=k)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of the first set that the second has, at most 1. An empty set is contained in any."""
    union = distinct_shingles(merged(a, b, k=k), k)
    part = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(part, F.lit(1.0)))


def text_form(sketch: Column) -> Column:
    """A sketch as text: 16 lower-case hexadecimal digits per hash."""
    return F.lower(F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def compared_with_edited(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of each document and of its edited text, whose last third of code points is the next document's beginning.

    doc_id, n_chars, edited_sha256, sketch, edited_sketch, near_edited, near_next (resemblances), contained_edited (how much of
    the document is in its edited text), n_shingles (estimated). The next document is that of the next smaller doc_id, after the last
    the first. A null text is an empty one. Documents with one doc_id follow each other by a hash of their texts, those without
    doc_id come last; rows equal in both are one document, which is compared once and has a row for each. Of other columns nothing
    is read. An empty table gives no rows.

    Order is found on three numbers per document. Texts are shuffled once, by document, and read from there twice: to hand a
    document's beginning and sketch to its predecessor, and to meet what has come from the successor.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    listed = kept(texts.select("doc_id", "hash", F.length("text").cast("bigint").alias("n_chars")), "lengths")
    rows = listed.count()
    once = kept(listed.groupBy("doc_id", "hash", "n_chars").agg(F.count("*").alias("copies")), "documents-once")
    total, most = once.agg(F.count("*"), F.max("copies")).first()
    if total < rows:
        texts = texts.dropDuplicates(["doc_id", "hash"])
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash")]
    placed = kept(numbered(once, order), "order")
    after = placed.select(
        F.pmod(F.col("position") - 1, F.lit(max(total, 1))).alias("position"),
        F.col("doc_id").alias("next_id"),
        F.col("hash").alias("next_hash"),
    )
    pairs = kept(placed.join(after, "position").drop("position"), "successors").alias("p")
    t = texts.alias("t")
    follows = F.col("t.doc_id").eqNullSafe(F.col("p.next_id")) & (F.col("t.hash") == F.col("p.next_hash"))
    third = F.expr("int(n_chars div 3)")
    handed = t.join(pairs, follows).select(
        F.col("p.doc_id").alias("doc_id"),
        F.col("p.hash").alias("hash"),
        "n_chars",
        "copies",
        F.substring("t.text", F.lit(1), third).alias("beginning"),
        F.col("t.text").alias("next_text"),
    )
    handed = with_sketch(handed, F.col("next_text"), "next_sketch", k, shingle).drop("next_text").alias("n")
    same = F.col("t.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("t.hash") == F.col("n.hash"))
    met = t.join(handed, same).select(
        "t.doc_id",
        "t.text",
        "n.n_chars",
        "n.copies",
        F.concat(F.substring("t.text", F.lit(1), F.expr("int(n_chars - n_chars div 3)")), "n.beginning").alias("edited"),
        "n.next_sketch",
    )
    done = with_sketch(met, F.col("text"), "sketch", k, shingle)
    done = with_sketch(done, F.col("edited"), "edited_sketch", k, shingle)
    sketch, edited = F.col("sketch"), F.col("edited_sketch")
    done = done.select(
        "doc_id",
        "copies",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "sketch",
        "edited_sketch",
        resemblance(sketch, edited, k).alias("near_edited"),
        resemblance(sketch, F.col("next_sketch"), k).alias("near_next"),
        containment(sketch, edited, k).alias("contained_edited"),
        distinct_shingles(sketch, k).alias("n_shingles"),
    )
    if total < rows:
        if most > COPIES_PER_TASK:  # deal the copies of one row out to many tasks
            done = done.withColumn("from", F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES_PER_TASK}L)")))
            done = done.withColumn("copies", F.least(F.col("copies") - F.col("from"), F.lit(COPIES_PER_TASK)))
            done = done.repartition("doc_id", "from").drop("from")
        done = done.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).drop("copy")
    return done.drop("copies")
