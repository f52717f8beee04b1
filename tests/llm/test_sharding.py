import hashlib
import math
import zlib

from pyspark.sql import functions as F

from assayer.llm.common import numbered
from assayer.llm.sharding import even_tree, grown, shard_of, sharded


def placed(spark, tree, n=20_000):
    return [r["shard"] for r in spark.range(n).select(shard_of(F.col("id"), tree).alias("shard")).collect()]


def test_one_more_shard_takes_rows_only_into_itself(spark):
    tree = even_tree(8)
    before, after = placed(spark, tree), placed(spark, grown(tree))
    moved = [(a, b) for a, b in zip(before, after) if a != b]
    assert {b for _, b in moved} == {8}
    assert abs(len(moved) / len(before) - 1 / 9) < 0.01
    assert all(abs(before.count(s) / len(before) - 1 / 8) < 0.01 for s in range(8))


def test_a_weight_moves_rows_into_its_own_subtree_only(spark):
    tree = {"r0": {"k0": {0: 1.0, 1: 1.0}}, "r1": {"k1": {2: 1.0}, "k2": {3: 1.0}}}
    heavier = {"r0": tree["r0"], "r1": {"k1": {2: 2.0}, "k2": {3: 1.0}}}
    moves = {(a, b) for a, b in zip(placed(spark, tree), placed(spark, heavier)) if a != b}
    # into the region that grew (either rack), or within it to the rack that grew; never between old shards of r0
    assert moves and all(b in (2, 3) for _, b in moves) and (2, 3) not in moves
    none = {"r0": {"k0": {0: 0.0, 1: 1.0}}, "r1": tree["r1"]}
    assert all(a == 0 for a, b in zip(placed(spark, tree), placed(spark, none)) if a != b and b == 1)
    assert 0 not in placed(spark, none)


def test_edge_rows(edge, nothing):
    rows = sharded(edge, even_tree(3)).collect()
    assert len(rows) == 12
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    null = [r for r in rows if r["doc_id"] == 1][0]
    assert (null["size"], null["text_crc32"], null["law"]) == (1, 0, "key")
    uni = [r for r in rows if r["doc_id"] == 7][0]
    data = "Ünï cödé 日本語 🙂 <|endoftext|>\x1cb".encode()
    assert (uni["size"], uni["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert sharded(nothing, even_tree(8)).collect() == []


def test_numbering_spreads_equal_rows(spark):
    rows = spark.range(5_000).select(F.lit(1).alias("key"), "id").repartition(7)
    done = numbered(rows, [F.col("key")])
    assert sorted(r["position"] for r in done.collect()) == list(range(5_000))


def plain_shard(key, tree):
    """The descent by the definition."""

    def least(level, children):
        def draw(name):
            share = (int(hashlib.md5(f"{key}|{level}|{name}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
            return -math.log(share) / children[name]

        return min(children, key=draw)

    region = least("", {r: sum(w for s in racks.values() for w in s.values()) for r, racks in tree.items()})
    rack = least(region, {k: sum(s.values()) for k, s in tree[region].items()})
    return least(f"{region}/{rack}", tree[region][rack])


def test_a_thousand_shards(spark):
    for tree in (even_tree(1_000), even_tree(1_000, per_rack=1_000), even_tree(300, per_rack=3, racks=20)):
        rows = spark.range(300).select("id", shard_of(F.col("id"), tree).alias("shard")).collect()
        assert all(r["shard"] == plain_shard(f"k{r['id']}", tree) for r in rows)
