"""Mixing sources to target weights by budgets over a domain-language-source tree. Built-in functions only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayer.llm.common import kept
from assayer.llm.fingerprints import words

LEVELS = ("domain", "lang", "source")
#: Leaves up to this number are broadcast.
BROADCAST_ROWS = 100_000
#: A leaf's cut is sought by so many leading digits of the draws, then by so many more: 256 sums a leaf each time.
BUCKET_DIGITS = (2, 4)


@dataclass(frozen=True)
class Mix:
    """Target weights and limits.

    weights: integers by node name, "domain", "domain/lang" or "domain/lang/source"; siblings that are not named weigh 1, and
    those of weight 0 get nothing. share: the budget as (numerator, denominator) of all tokens. epochs: how often a document
    may be taken at most.
    """

    weights: Mapping[str, int] = field(default_factory=dict)
    share: tuple[int, int] = (4, 5)
    epochs: int = 2
    seed: int = 7


def tokens(text: str) -> Column:
    """Words of a text, as the tokens that budgets count."""
    return F.size(words(F.coalesce(F.col(text), F.lit("")))).cast("bigint")


def draw(doc_id: Column, epoch: Column, seed: int) -> Column:
    """A document's place in the shuffled order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _weight(mix: Mix, level: int) -> Column:
    name = F.concat_ws("/", *(F.coalesce(F.col(c), F.lit("")) for c in LEVELS[: level + 1]))
    own = {k: v for k, v in mix.weights.items() if k.count("/") == level}
    if not own:
        return F.lit(1).cast("bigint")
    table = F.create_map(*(F.lit(x) for pair in own.items() for x in pair))
    return F.coalesce(F.element_at(table, name), F.lit(1)).cast("bigint")


def _shared(nodes: DataFrame, level: int) -> DataFrame:
    """`nodes` of a level (weight, capacity, above: the parent's budget) with their budget.

    Siblings get parts of the parent's budget by weight. One whose part exceeds its capacity gets that, and what it leaves is
    shared by the others by weight again. In the order of capacity per weight those that are filled come first, so one pass finds
    them: a node is filled if its part of what the earlier ones left exceeds its capacity. Odd tokens go to the first of the others.
    """
    siblings = Window.partitionBy(*LEVELS[:level])
    ordered = siblings.orderBy(F.col("capacity") / F.greatest("weight", F.lit(1)), LEVELS[level])
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)

    def wide(c: Column) -> Column:
        return c.cast("decimal(18,0)")

    zero = F.lit(0).cast("bigint")
    nodes = nodes.withColumns(
        {
            "filled_before": F.coalesce(F.sum("capacity").over(earlier), zero),
            "weight_left": F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(earlier), zero),
        }
    )
    fits = wide(F.col("capacity")) * wide(F.col("weight_left")) <= wide(F.col("above") - F.col("filled_before")) * wide(F.col("weight"))
    nodes = nodes.withColumn("filled", F.min(fits).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    nodes = nodes.withColumns(
        {
            "left": F.col("above") - F.coalesce(F.sum(F.when(F.col("filled"), F.col("capacity"))).over(siblings), zero),
            "weights": F.coalesce(F.sum(F.when(~F.col("filled"), F.col("weight"))).over(siblings), zero),
        }
    )
    part = F.when(
        ~F.col("filled"), F.expr("(cast(left as decimal(18,0)) * cast(weight as decimal(18,0))) div cast(weights as decimal(18,0))")
    )
    nodes = nodes.withColumn("part", part)
    odd = F.col("left") - F.sum("part").over(siblings)
    place = F.sum(F.when(~F.col("filled"), 1).otherwise(0)).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    budget = F.when(F.col("filled"), F.col("capacity")).otherwise(F.col("part") + F.when(place <= odd, 1).otherwise(0))
    return nodes.withColumn("budget", budget.cast("bigint"))


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """domain, lang, source, tokens, budget of each leaf of `leaves` (domain, lang, source, tokens).

    Capacities (tokens times epochs) add up from the leaves, weights and budgets go down from the root. As a node never gets more
    than its leaves can give, a shortage goes to siblings first and to the siblings of its ancestors only when all of
    its own are full. The root gets the share of all tokens, or all capacity if that is less.
    """
    nodes = {2: leaves.withColumn("capacity", F.col("tokens") * mix.epochs)}
    for level in (2, 1, 0):
        weighed = nodes[level].withColumn("weight", _weight(mix, level))
        nodes[level] = weighed.withColumn("capacity", F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0).cast("bigint"))
        if level:
            nodes[level - 1] = nodes[level].groupBy(*LEVELS[:level]).agg(F.sum("capacity").alias("capacity"))
    everything = leaves.agg(F.sum("tokens")).first()[0] or 0  # two numbers come to the driver
    capacity = nodes[0].agg(F.sum("capacity")).first()[0] or 0
    root = min(everything * mix.share[0] // mix.share[1], capacity)
    shared = _shared(nodes[0].withColumn("above", F.lit(root).cast("bigint")), 0).select("domain", "budget")
    for level in (1, 2):
        above = shared.withColumnRenamed("budget", "above").alias("a")
        same = F.lit(True)
        for c in LEVELS[:level]:
            same &= F.col(f"n.{c}").eqNullSafe(F.col(f"a.{c}"))
        below = nodes[level].alias("n").join(above, same).select("n.*", "above")
        shared = _shared(below, level).select(*LEVELS[: level + 1], *(["tokens"] if level == 2 else []), "budget")
    return shared


def cuts(rows: DataFrame, mix: Mix) -> DataFrame:
    """domain, lang, source, whole (epochs taken in full), cut: in the next epoch, documents up to this draw are taken (null: none).

    `rows`: domain, lang, source, doc_id, tokens. A leaf's cut is the least draw at which its rest of the budget is reached, so the last
    document is whole and a leaf exceeds its budget by less than that. Rows with one doc_id have one draw and are taken
    together. Tokens are added per bucket of draws, again per bucket within that which has the cut, and only the last one is
    looked at row by row.
    """
    leaves = kept(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "leaves")
    shares = budgets(leaves, mix).withColumns(
        {
            "whole": F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0),
            "rest": F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0),
        }
    )
    shares = kept(shares.select(*LEVELS, "whole", "rest"), "leaf-budgets")
    inside = _with_leaf(rows, shares).filter("rest > 0").withColumnRenamed("rest", "more")
    inside = inside.withColumn("draw", draw(F.col("doc_id"), F.col("whole"), mix.seed)).drop("whole")
    ordered = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    for digits in BUCKET_DIGITS:
        bucketed = inside.withColumn("bucket", F.substring("draw", 1, digits))
        sums = bucketed.groupBy(*LEVELS, "more", "bucket").agg(F.sum("tokens").alias("tokens"))
        found = (
            sums.withColumn("upto", F.sum("tokens").over(ordered))
            .filter("upto >= more and upto - tokens < more")
            .select(*LEVELS, F.col("bucket").alias("cut_bucket"), (F.col("more") - F.col("upto") + F.col("tokens")).alias("more"))
        )
        found = kept(found, "cut-buckets")
        inside = _with_leaf(bucketed.drop("more"), found).filter("bucket = cut_bucket").drop("bucket", "cut_bucket")
    peers = Window.partitionBy(*LEVELS).orderBy("draw").rangeBetween(Window.unboundedPreceding, 0)
    reached = (
        inside.withColumn("upto", F.sum("tokens").over(peers))
        .filter("upto >= more")
        .groupBy(*LEVELS)
        .agg(F.min("draw").alias("cut"))
    )
    return kept(_with_leaf(shares, reached, "left").select(*LEVELS, "whole", "cut"), "cuts")


def _with_leaf(rows: DataFrame, leaves: DataFrame, how: str = "inner") -> DataFrame:
    """`rows` with what `leaves` say of their leaf; nulls are names like others."""
    same = F.lit(True)
    for c in LEVELS:
        same &= F.col(f"r.{c}").eqNullSafe(F.col(f"l.{c}"))
    if leaves.count() <= BROADCAST_ROWS:
        leaves = F.broadcast(leaves)
    others = [c for c in leaves.columns if c not in LEVELS]
    return rows.alias("r").join(leaves.alias("l"), same, how).select("r.*", *(f"l.{c}" for c in others))


def taken(rows: DataFrame, leaf_cuts: DataFrame, mix: Mix) -> DataFrame:
    """`rows` (domain, lang, source, doc_id and others), each once for every epoch in which it is taken, with that epoch."""
    marked = _with_leaf(rows, leaf_cuts)
    partly = (draw(F.col("doc_id"), F.col("whole"), mix.seed) <= F.col("cut")).cast("int")
    copies = F.col("whole").cast("int") + F.coalesce(partly, F.lit(0))
    epochs = F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))
    return marked.withColumn("_copies", copies).filter("_copies > 0").withColumn("epoch", epochs).drop("_copies", "whole", "cut")


def mixed(docs: DataFrame, mix: Mix, domain: Column) -> DataFrame:
    """doc_id, domain, lang, source, tokens, epoch for each time a document of `docs` (doc_id, text, lang, source) is taken.

    Nulls in lang and source are names of their own; a null domain too. A null or empty text has no tokens: it comes with whole epochs
    and where its draw is before the cut. Leaves without tokens give nothing. Rows with one doc_id in a leaf are taken
    together. Of other columns nothing is read. An empty table gives no rows.
    """
    rows = docs.select("doc_id", domain.alias("domain"), "lang", "source", tokens("text").alias("tokens"))
    rows = kept(rows, "token-counts")
    return taken(rows, cuts(rows, mix), mix).select("doc_id", "domain", "lang", "source", "tokens", "epoch")


def resampled(docs: DataFrame, mix: Mix, domain: Column) -> DataFrame:
    """`docs` themselves, each row once for every epoch in which it is taken. Only leaves' cuts meet the texts."""
    rows = docs.select("doc_id", domain.alias("domain"), "lang", "source", tokens("text").alias("tokens"))
    leaf_cuts = cuts(kept(rows, "token-counts"), mix)
    named = docs.select(
        "doc_id", domain.alias("domain"), "lang", "source", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    )
    return taken(named, leaf_cuts, mix).select("row.*")


#: `documents` has no domain; a stand-in that depends on the source alone.
DOMAINS = ("books", "forums", "web")


def source_domain() -> Column:
    at = F.pmod(F.crc32(F.encode(F.coalesce("source", F.lit("")), "UTF-8")), F.lit(len(DOMAINS)))
    return F.element_at(F.array(*map(F.lit, DOMAINS)), at.cast("int") + 1)


#: Weights of the query and of the pipeline.
DEFAULT = Mix(weights={"books": 3, "forums": 2, "web": 5} | {f"{d}/en": 4 for d in DOMAINS} | {f"{d}/de": 2 for d in DOMAINS})
