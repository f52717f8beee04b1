"""Unique keys and duplicate groups.

Counting is a plain `groupBy(key).count()`: partial aggregation leaves one row per key and task
before the shuffle, so a key that holds a third of the table is no hot spot. Fetching the repeated
rows needs the rows next to their key's count, and there a hot key would be one: its rows are spread
over as many salts as it has millions of rows. Where a count has already told that few keys repeat, they
are broadcast and the rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayer.functions.columns import column, column_type, free_names, group_key
from assayer.model import CheckError

# A key with more rows than this gets one salt per so many rows. There are at most rows / ROWS_PER_SALT such keys,
# which bounds the broadcast that names them: 16 MB for a million million rows.
ROWS_PER_SALT = 1_000_000
# Repeated keys are broadcast when they are known to be at most so many; with text keys as digests and
# fixed-width ties that is some 100 bytes each.
BROADCAST_KEYS = 500_000
# So many copies of one row are written by one task.
COPIES_PER_TASK = 100_000
# Types of values that are compared and shuffled as a few bytes.
FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def duplicate_groups(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Groups of equal values in `columns` that hold more than one row, with `group_rows`."""
    return (
        rows.groupBy(*map(column, columns))
        .agg(F.count(F.lit(1)).alias("group_rows"))
        .filter("group_rows > 1")
    )


def repeated_rows(
    rows: DataFrame,
    keys: Sequence[str],
    mode: str = "extra",
    tie: Sequence[str] | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
    keys_at_most: int | None = None,
) -> DataFrame:
    """Rows whose `keys` (none NULL) occur more than once.

    mode "all" gives every row of such a key, "extra" all but one. Which one is left out is decided by
    `tie`, columns that tell a key's rows apart: the row with the least tie stays (where several rows share
    it, the least of these by all columns). Without `tie` the least row by all its columns stays, which also holds for rows that are copies of each other.
    There the table's first columns of fixed width are the tie: the least by all columns is among the least by these, and only
    rows that share it are compared as a whole.
    `keys_at_most` is how many keys can repeat, where that is known.
    """
    if mode not in ("all", "extra"):
        raise CheckError(f"mode must be 'extra' or 'all', not {mode!r}")
    spread = [column(c) for c in tie] if tie else _hashable(rows)
    if mode == "extra" and not tie:
        for fld in rows.schema.fields:
            if not _is_plain(fld.dataType):
                raise CheckError(f"name tie columns: {fld.name!r} cannot be ordered")
        tie = _first_columns(rows, keys)
        if not tie:
            every = repeated_rows(rows, keys, "all", None, rows_per_salt, keys_at_most)
            return _all_but_least(every, keys)

    for key in keys:
        rows = rows.filter(column(key).isNotNull())
    names = rows.columns
    helpers = free_names(names, ["__n", "__least", "__first", "__hash", "__splits", "__salt", "__key_salt"])
    n, least, at_least = helpers[:3]
    salts = helpers[3:]
    key_names = free_names(names, [f"__k{i}" for i in range(len(keys))])
    row_names = free_names([*names, *key_names], [f"__r{i}" for i in range(len(keys))])
    row_keys = [_filled(rows, k) for k in keys]
    own = [k.alias(name) for k, name in zip(row_keys, key_names)]
    if mode == "all":
        counts = rows.groupBy(*own).agg(F.count(F.lit(1)).alias(n))
    else:
        # Rows per key and tie, then per key with its least tie and the rows that share it: one pass tells
        # which keys' ties do not tell their rows apart. NULL comes before all other ties.
        first = F.min(F.struct(F.col(least), F.col(n).alias(at_least)))
        by_tie = rows.groupBy(*own, _tie(tie).alias(least)).agg(F.count(F.lit(1)).alias(n))
        counts = by_tie.groupBy(*key_names).agg(F.sum(n).alias(n), first.alias(at_least))
        counts = counts.select(*key_names, n, F.col(at_least).getField(least).alias(least), F.col(at_least).getField(at_least).alias(at_least))
    counts = counts.filter(F.col(n) > 1)
    few = keys_at_most is not None and keys_at_most <= BROADCAST_KEYS
    few = few and _is_narrow(rows, [*keys, *(tie or [])], tie or [])
    rows = rows.withColumns(dict(zip(row_names, row_keys)))
    pairs = list(zip(row_names, key_names))
    if few:
        counts = F.broadcast(counts.drop(n))
    else:
        rows, counts = _salted(rows, row_names, spread, counts, key_names, rows_per_salt, n, salts)
        pairs.append((salts[2], salts[3]))
    same = reduce(Column.__and__, [F.col(left) == F.col(right) for left, right in pairs])
    if mode == "all":
        return rows.join(counts, same, "left_semi").select(*map(column, names))
    stays = _tie(tie).eqNullSafe(F.col(least))
    apart = rows.join(counts, same).filter(~stays).select(*map(column, names))
    shared = rows.join(counts.filter(F.col(at_least) > 1), same).filter(stays)
    return apart.unionByName(_tied_rows(shared.select(*map(column, names)), keys))


def _tied_rows(tied: DataFrame, keys) -> DataFrame:
    """Of rows that share their key's least tie all but one."""
    if all(_is_plain(f.dataType) for f in tied.schema.fields):
        return _all_but_least(tied, keys)
    # Rows that cannot be ordered as a whole: one of those with the least tie is as good as another.
    place = free_names(tied.columns, ["__place"])[0]
    window = Window.partitionBy(*map(column, keys)).orderBy(F.lit(0))
    placed = tied.withColumn(place, F.row_number().over(window))
    return placed.filter(F.col(place) > 1).select(*map(column, tied.columns))


def _filled(rows: DataFrame, name: str) -> Column:
    """A grouping key of rows without NULL keys. Saying so spares the joins a NULL filter, which would
    compute the digests of texts once more."""
    key = group_key(rows, name)
    return F.coalesce(key, F.lit("")) if column_type(rows, name) == T.StringType() else key


def _tie(tie: Sequence[str]) -> Column:
    # A single column keeps min() a hash aggregate; a struct makes it a sort aggregate.
    return column(tie[0]) if len(tie) == 1 else F.struct(*map(column, tie))


def _salted(rows, row_names, spread, counts, key_names, rows_per_salt, n, names):
    """Both sides with a salt: 0, but for hot keys, whose count rows are repeated once per salt.

    Hot keys are told by hash. The salt is computed from the row's own values in `spread`, so a task
    that runs again gives the same one. `names` are those of the hash, the splits and either side's salt.
    """
    hash_, splits, salt, key_salt = names
    hot = (
        counts.filter(F.col(n) > rows_per_salt)
        .select(
            F.xxhash64(*key_names).alias(hash_),
            F.ceil(F.col(n) / rows_per_salt).cast("bigint").alias(splits),
        )
        .groupBy(hash_)
        .agg(F.max(splits).alias(splits))
    )
    hot = F.broadcast(hot)  # two bigints a row
    salted_rows = (
        rows.withColumn(hash_, F.xxhash64(*row_names))
        .join(hot, hash_, "left")
        .withColumn(
            salt,
            F.coalesce(F.pmod(F.xxhash64(*spread), F.col(splits)), F.lit(0).cast("bigint")),
        )
    )
    salted_counts = (
        counts.withColumn(hash_, F.xxhash64(*key_names))
        .join(hot, hash_, "left")
        .withColumn(
            key_salt,
            F.explode(
                F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(splits), F.lit(1)) - 1)
            ),
        )
        .drop(hash_, splits, n)
    )
    return salted_rows, salted_counts


def _is_narrow(rows: DataFrame, names: Sequence[str], kept_whole: Sequence[str]) -> bool:
    """Whether keys and ties are of bounded width; texts are, as keys, by their digest."""
    return all(
        isinstance(column_type(rows, n), FIXED_WIDTH)
        or (column_type(rows, n) == T.StringType() and n not in kept_whole)
        for n in names
    )


def _first_columns(rows: DataFrame, keys: Sequence[str]) -> list[str]:
    """The columns of fixed width that the table begins with, keys left out: rows of a key that differ in them are ordered by them
    as by all columns."""
    own, first = {k.lower() for k in keys}, []
    for fld in rows.schema.fields:
        if fld.name.lower() in own:
            continue
        if not isinstance(fld.dataType, FIXED_WIDTH):
            break
        first.append(fld.name)
    return first


def _is_plain(dtype: T.DataType) -> bool:
    """Whether values of a type can be hashed and ordered."""
    return not any(t in dtype.simpleString() for t in ("map<", "variant"))


def _hashable(rows: DataFrame) -> list[Column]:
    return [column(f.name) for f in rows.schema.fields if _is_plain(f.dataType)]


def _all_but_least(repeated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated rows less one per key: a multiset difference, so copies are counted out exactly."""
    for fld in repeated.schema.fields:
        if not _is_plain(fld.dataType):
            raise CheckError(f"name tie columns: {fld.name!r} cannot be ordered")
    names = repeated.columns
    n, least = free_names(names, ["__n", "__least"])
    key_names = free_names(names, [f"__k{i}" for i in range(len(keys))])
    one_each = (
        repeated.groupBy(*[group_key(repeated, k).alias(name) for k, name in zip(keys, key_names)])
        .agg(F.min(F.struct(*map(column, names))).alias(least))
        .select(*[F.col(least).getField(c).alias(c) for c in names], F.lit(-1).alias(n))
    )
    left = (
        repeated.withColumn(n, F.lit(1))
        .unionByName(one_each)
        .groupBy(*map(column, names))
        .agg(F.sum(n).alias(n))
    )
    return _copied(left, names, n)


def _copied(counted: DataFrame, names: Sequence[str], n: str) -> DataFrame:
    """Each row as often as `n` says. Many copies of one row are dealt out to many tasks."""
    begin, copy = free_names([*names, n], ["__from", "__copy"])
    few = counted.filter((F.col(n) > 0) & (F.col(n) <= COPIES_PER_TASK))
    many = (
        counted.filter(F.col(n) > COPIES_PER_TASK)
        .withColumn(begin, F.explode(F.expr(f"sequence(0L, {n} - 1, {COPIES_PER_TASK}L)")))
        .repartition(*map(column, names), begin)
        .withColumn(n, F.least(F.col(n) - F.col(begin), F.lit(COPIES_PER_TASK)))
        .drop(begin)
    )
    copies = F.explode(F.expr(f"sequence(1L, {n})"))
    return few.unionByName(many).withColumn(copy, copies).select(*map(column, names))
