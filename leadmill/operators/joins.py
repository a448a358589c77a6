"""Join shapes that Spark would otherwise plan as nested loops, or that concentrate on hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

KeyPair = tuple[str, str]


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _equal(left: DataFrame, right: DataFrame, pairs: Sequence[KeyPair]) -> Column:
    return _all([left[a] == right[b] for a, b in pairs])


def disjunctive_pairs(
    left: DataFrame,
    right: DataFrame,
    left_key: Sequence[str],
    arms: Sequence[Sequence[KeyPair]],
    within_days: tuple[str, str, int] | None = None,
    distinct_left: bool = True,
) -> DataFrame:
    """Matches of ``left`` and ``right`` where at least one arm's equalities all hold.

    One hash-partitioned equi join per arm. A pair that satisfies several arms is kept by the first
    one only, so every match comes out exactly once. ``within_days=(right_time, left_time, n)``
    additionally asks for ``right_time`` to fall on a date in ``[left date, left date + n]``; the
    date enters the join key as a window number, so that a popular id does not pair all of its rows.

    The result holds ``left_key`` and the columns of ``right``. ``left_key`` must determine the left
    columns that the arms and the interval use; pass ``distinct_left=False`` where it is unique.
    """
    used = list(dict.fromkeys([*left_key, *[a for arm in arms for a, _ in arm]]))
    if within_days:
        right_time, left_time, days = within_days
        used = list(dict.fromkeys([*used, left_time]))
    slim = left.select(*used)
    if distinct_left:
        slim = slim.distinct()
    slim = slim.select(*[F.col(c).alias(f"__l_{c}") for c in used])
    if within_days:
        width = days + 1
        window_of = lambda d: F.floor(F.unix_date(d) / width)
        first = F.to_date(F.col(f"__l_{left_time}"))
        slim = slim.withColumn(
            "__window", F.explode(F.sequence(window_of(first), window_of(F.date_add(first, days))))
        )
        right = right.withColumn("__window", window_of(F.to_date(F.col(right_time))))

    def holds(arm: Sequence[KeyPair]) -> Column:
        return _all([F.col(f"__l_{a}") == F.col(b) for a, b in arm])

    out = []
    for i, arm in enumerate(arms):
        on = [holds(arm)]
        if within_days:
            on.append(slim["__window"] == right["__window"])
            start = F.to_date(F.col(f"__l_{left_time}"))
            on.append(F.to_date(F.col(right_time)).between(start, F.date_add(start, days)))
        for earlier in arms[:i]:
            on.append(~F.coalesce(holds(earlier), F.lit(False)))
        joined = slim.join(right, _all(on), "inner")
        keys = [F.col(f"__l_{c}") for c in left_key]
        out.append(joined.select(*keys, *[F.col(c) for c in right.columns if c != "__window"]))
    return reduce(DataFrame.unionByName, out)


def disjunctive_left_join(
    left: DataFrame,
    right: DataFrame,
    arms: Sequence[Sequence[KeyPair]],
    within_days: tuple[str, str, int] | None = None,
) -> DataFrame:
    """Left join on an OR of equalities.

    The left columns ride through the arms, and the rows without a match come from anti joins. So every
    join has the left rows on a side that Spark can split where a key is hot. Column names of the two sides
    must differ.
    """
    matched = disjunctive_pairs(left, right, left.columns, arms, within_days, distinct_left=False)
    matched = matched.select(*[F.col(f"__l_{c}").alias(c) for c in left.columns], *right.columns)
    lonely = _without_match(left, right, arms, within_days)
    return matched.unionByName(lonely, allowMissingColumns=True)


def _without_match(
    left: DataFrame, right: DataFrame, arms: Sequence[Sequence[KeyPair]], within_days: tuple[str, str, int] | None
) -> DataFrame:
    """Rows of ``left`` that no arm matches: one anti join per arm, and per window that the interval touches."""
    if not within_days:
        return reduce(lambda rows, arm: rows.join(right, _equal(left, right, arm), "left_anti"), arms, left)
    right_time, left_time, days = within_days
    width = days + 1
    start = F.to_date(left[left_time])
    times = right.withColumn("__window", F.floor(F.unix_date(F.to_date(F.col(right_time))) / width))
    inside = F.to_date(times[right_time]).between(start, F.date_add(start, days))
    rows = left
    for arm in arms:
        for at in (start, F.date_add(start, days)):
            window = F.floor(F.unix_date(at) / width) == times["__window"]
            rows = rows.join(times, _equal(left, times, arm) & window & inside, "left_anti")
    return rows


def days_between(start: Column, end: Column) -> Column:
    """Array of the dates from start to end; empty when the end is earlier, NULL when either is."""
    return F.when(start <= end, F.sequence(start, end)).when(
        start > end, F.array().cast("array<date>")
    )


def range_join(
    left: DataFrame,
    left_key: str,
    first: Column,
    last: Column,
    dates: DataFrame,
    date_col: str,
    how: str = "inner",
) -> DataFrame:
    """Join rows to the dates of a calendar that fall into ``[first, last]``.

    Each range is unrolled into its days, which meet the calendar in an equi join. ``left_key`` is
    unique in ``left``; the left form keeps rows without any date.
    """
    days = left.select(
        F.col(left_key).alias("__key"), F.explode(days_between(first, last)).alias("__day")
    )
    hits = days.join(dates, days["__day"] == dates[date_col], "inner").drop("__day")
    if how == "inner":
        return left.join(hits, left[left_key] == hits["__key"], "inner").drop("__key")
    return left.join(hits, left[left_key].eqNullSafe(hits["__key"]), "left").drop("__key")


def one_to_many(one: DataFrame, many: DataFrame, on: str, many_keys: DataFrame | None = None) -> DataFrame:
    """Rows of ``one`` (unique on the key) with all their rows of ``many``, or with none: a left join.

    The matches are joined as an inner join with ``many`` as the long side, so that Spark can split a hot
    key's rows, which it cannot do on the right of a left join. ``many_keys`` may name a cheaper frame
    with the keys of ``many``.
    """
    keys = many if many_keys is None else many_keys
    found = keys.select(F.col(on).alias("__key")).distinct()
    matched = many.join(one, on, "inner")
    lonely = one.join(found, one[on] == found["__key"], "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def fanout_left_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    parts: int = 1000,
    min_rows: int = 100_000,
    left_rows: DataFrame | None = None,
    left_spread: Sequence[str] | None = None,
    right_spread: Sequence[str] | None = None,
    one: DataFrame | None = None,
) -> DataFrame:
    """N:M left join on one column that stays balanced when a key is hot on either side.

    A key is hot where it holds more than one ``parts``-th of a side's rows (and more than ``min_rows``).
    Its rows are cut into a grid: the left ones into ``a`` parts, the right ones into ``b`` parts, and
    every part of one side meets every part of the other in a cell of its own. Each pair of rows meets in
    exactly one cell. Other keys join as usual. By definition there are at most ``2 * parts`` hot keys,
    so their list is broadcast.

    ``left_rows`` may name a cheaper frame whose rows per key stand in for those of ``left``. ``left_spread`` and
    ``right_spread`` name columns that tell the rows of a hot key apart; by default all columns do, and then none of
    them can be left out where a query does not ask for it.

    With ``one``, unique on the key, the result is its rows with all their left and right rows, or with none of either:
    they are repeated for the cells of hot keys and meet the left rows there, which are moved only once. ``left_rows`` then
    holds no other keys than ``left``.
    """

    def sizes(df: DataFrame, name: str) -> tuple[DataFrame, Column]:
        counts = df.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias(name))
        total = counts.agg(F.coalesce(F.sum(name), F.lit(0)).alias("n")).scalar()
        return counts, F.greatest(F.lit(min_rows), F.ceil(total / F.lit(parts)))

    n_left, left_limit = sizes(left if left_rows is None else left_rows, "__n_left")
    n_right, right_limit = sizes(right, "__n_right")
    hot = (
        n_left.join(n_right, on, "left")
        .select(
            F.col(on).alias("__hot"),
            F.ceil(F.col("__n_left") / left_limit).cast("int").alias("__a"),
            F.coalesce(F.ceil(F.col("__n_right") / right_limit).cast("int"), F.lit(1)).alias("__b"),
        )
        .where("__a > 1 OR __b > 1")
    )

    def cells(spread: Sequence[str], own: str, other: str) -> tuple[Column, Column]:
        own_part = F.pmod(F.xxhash64(*spread), F.col(own)).cast("int")
        other_parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other) - 1, F.lit(0))))
        return F.coalesce(own_part, F.lit(0)), other_parts

    own, others = cells(left_spread or left.columns, "__a", "__b")
    l = left.join(F.broadcast(hot), left[on] == hot["__hot"], "left").select(
        *left.columns, "__b", own.alias("__left_a"), others.alias("__left_b")
    )
    own, others = cells(right_spread or right.columns, "__b", "__a")
    r = right.join(F.broadcast(hot), right[on] == hot["__hot"], "left").select(
        F.col(on).alias("__right_key"), *[c for c in right.columns if c != on],
        own.alias("__right_b"), others.alias("__right_a"),
    )
    own_cols = left.columns
    if one is not None:
        own_cols = [*one.columns, *[c for c in left.columns if c != on]]
        l = _in_cells(one, hot, on).join(
            l.drop("__b").withColumnRenamed(on, "__left_key"),
            (F.col(on) == F.col("__left_key"))
            & (F.col("__one_a") == F.col("__left_a"))
            & (F.col("__one_b") == F.col("__left_b")),
            "left",
        )
        # Where the left rows of a key are cut, there are some, so a cell without any is no row without them.
        l = l.where(F.col("__left_key").isNotNull() | (F.coalesce("__a", F.lit(1)) == 1))
        l = l.drop("__left_a", "__left_b").withColumnsRenamed({"__one_a": "__left_a", "__one_b": "__left_b"})
    same_cell = (
        (F.col(on) == F.col("__right_key"))
        & (F.col("__left_a") == F.col("__right_a"))
        & (F.col("__left_b") == F.col("__right_b"))
    )
    # Where the right rows of a key are cut, there are some, so a cell without any is no unmatched row.
    matched = F.col("__right_key").isNotNull()
    kept = l.join(r, same_cell, "left").where(matched | (F.coalesce("__b", F.lit(1)) == 1))
    return kept.select(*own_cols, *[c for c in right.columns if c != on])


def _in_cells(one: DataFrame, hot: DataFrame, on: str) -> DataFrame:
    """Rows of ``one`` in each cell of their key."""
    a, b = F.coalesce("__a", F.lit(1)), F.coalesce("__b", F.lit(1))
    rows = one.join(F.broadcast(hot), one[on] == hot["__hot"], "left")
    rows = rows.select(*one.columns, "__a", "__b", F.explode(F.sequence(F.lit(0), a * b - 1)).alias("__cell"))
    cell = F.col("__cell")
    return rows.select(
        *one.columns, "__a", "__b",
        F.floor(cell / b).cast("int").alias("__one_a"), F.pmod(cell, b).cast("int").alias("__one_b"),
    )
