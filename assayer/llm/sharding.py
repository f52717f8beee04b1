"""Shards by a hierarchical weighted hash tree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import numbered

#: Region -> rack -> shard number -> weight.
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]


def even_tree(shards: int, per_rack: int = 2, racks: int = 2) -> Tree:
    """`shards` shards of weight 1 in racks of `per_rack` and regions of `racks` racks; a region is filled before the next begins.

    One more shard opens a rack or a region only where the last is full, see `grown`.
    """
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(shards):
        rack = shard // per_rack
        tree.setdefault(f"region{rack // racks}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    return tree


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """`tree` with one more shard, alone in a rack of a new region.

    No old subtree changes its weight, so no row moves between old shards: whatever moves, moves into the new region.
    """
    shard = 1 + max((s for racks in tree.values() for shards in racks.values() for s in shards), default=-1)
    return {**tree, f"added{shard}": {f"added{shard}": {shard: weight}}}


def _children(children: Sequence[tuple[str, float, int]]) -> Column:
    """Siblings as an array: what is hashed with the key, the weight, and the number of the child."""
    each = [F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), F.lit(i).alias("number")) for n, w, i in children]
    return F.array(*each)


def _drawn(key: Column, siblings: Column) -> Column:
    """The number of the sibling with the least exponential draw; one of weight w wins with the chance w / sum of weights.

    A child's draw depends on the key, its name and its own weight only. A weight that rises draws rows to that child alone,
    one that falls gives rows away from that child alone. Of equal draws the first child's wins.
    """

    def draw(child: Column) -> Column:
        digits = F.substring(F.md5(F.concat(key, child["name"])), 1, 13)
        share = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
        return F.struct((-F.log(share) / child["weight"]).alias("draw"), child["number"].alias("number"))

    return F.array_min(F.transform(siblings, draw))["number"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard (int) of a key: a draw among the regions, then among the racks of that region, then among its shards.

    Inner weights are sums of their shards'. Shards without a positive weight get nothing. A null key is a key of its own. The tree
    is data, arrays of siblings by the number of their parent, so the expression is as long for a thousand shards as for two.
    """
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    regions: list[tuple[str, float, int]] = []
    racks_of: list[Column] = []
    shards_of: list[Column] = []
    for region, racks in tree.items():
        inner = []
        for rack, shards in racks.items():
            leaves = [(f"|{region}/{rack}|{s}", w, s) for s, w in shards.items() if w > 0]
            if leaves:
                inner.append((f"|{region}|{rack}", sum(w for _, w, _ in leaves), len(shards_of)))
                shards_of.append(_children(leaves))
        if inner:
            regions.append((f"||{region}", sum(w for _, w, _ in inner), len(racks_of)))
            racks_of.append(_children(inner))
    if not regions:
        raise ValueError("no shard has a positive weight")
    rack = _drawn(text, F.get(F.array(*racks_of), _drawn(text, _children(regions))))
    return _drawn(text, F.get(F.array(*shards_of), rack)).cast("int")


def sharded(docs: DataFrame, tree: Tree, next_tree: Tree | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of `docs` (doc_id, text).

    `slot` counts a shard's rows from 0 in the order of (doc_id, text_crc32, size). Rows repeated in all of these have slots of
    their own in any order. A null text has size 1 and the checksum of no bytes; a null doc_id is a key like any other and
    comes first. Of other columns nothing is read. An empty table gives no rows. Texts are read once and never shuffled.
    """
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select(
        "doc_id",
        (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree).alias("shard"),
        shard_of(F.col("doc_id"), next_tree or grown(tree)).alias("grown_shard"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("shard", "doc_id", "text_crc32", "size")]
    placed = numbered(rows, order)
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))  # a row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "law",
        "shard",
        (F.col("position") - F.col("first")).alias("slot"),
        "grown_shard",
    )
