"""Running counts and sums inside a group when one group may hold a large part of the table.

A prefix count in one lazy plan: a group is cut into slices by the content of its rows, each slice is
numbered by a window of its own, and what lies before a slice is added. The cuts are those of the
group's rows whose hash falls on one in `SLICE_ROWS`, so a slice holds about that many rows whatever
the size of the group, most groups have no cut at all, and the same rows give the same cuts however
often and wherever they are read: no job runs while the plan is built, and nothing is written.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows of a slice, on average.
SLICE_ROWS = 1 << 20
# Cuts that are searched one by one, after as many coarse ones.
SEARCHED = 512


def _cuts(df: DataFrame, key: str, order: list[str], slice_rows: int) -> DataFrame:
    """`key, _cuts`: sorted cuts of the groups that have any; one row in `slice_rows` is kept."""
    chosen = df.filter(F.pmod(F.xxhash64(*order), F.lit(slice_rows)) == 0)
    cuts = F.sort_array(F.collect_set(F.struct(*order))).alias("_cuts")
    return chosen.filter(F.col(key).isNotNull()).groupBy(key).agg(cuts)


def _slice(row: Column, cuts: Column) -> Column:
    """How many cuts lie before `row`, or null without cuts; found in two steps."""
    n = F.size(cuts)
    places = F.sequence(F.lit(1), n, F.lit(SEARCHED))
    coarse = F.size(F.filter(F.transform(places, lambda at: F.element_at(cuts, at)), lambda c: c < row))
    start = F.greatest(coarse - 1, F.lit(0)) * SEARCHED
    near = F.size(F.filter(F.slice(cuts, start + 1, F.lit(SEARCHED)), lambda c: c < row))
    return F.when(n > 0, start + near)


def running_within(
    df: DataFrame,
    key: str,
    order: list[str],
    sums: dict[str, Column],
    name: str = "position",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add `name`: 1, 2, … within `key` by `order`, and running totals of `sums` before each row.

    Rows that agree in all of `order` lie in one slice and follow each other in any order.
    """
    # One row in `slice_rows` at most: broadcast, so that rows go straight to their slice's window.
    cuts = F.broadcast(_cuts(df, key, order, slice_rows))

    def in_slices(how: str) -> DataFrame:
        place = F.coalesce(_slice(F.struct(*order), F.col("_cuts")), F.lit(0))
        return df.join(cuts, key, how).withColumn("_slice", place)

    sliced = in_slices("left")
    total = {f"_{n}": F.sum(c) for n, c in sums.items()} | {"_rows": F.count("*")}
    # Only groups with cuts have slices before others: a few rows per such group.
    counts = (
        in_slices("inner")
        .groupBy(key, "_slice")
        .agg(*(column.alias(n) for n, column in total.items()))
    )
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(key, "_slice", *(F.sum(n).over(earlier).alias(n) for n in total))
    inside = Window.partitionBy(key, "_slice").orderBy(*order)
    until = inside.rowsBetween(Window.unboundedPreceding, -1)

    def with_offset(n: str, own: Column) -> Column:
        return F.coalesce(own, F.lit(0)) + F.coalesce(n, F.lit(0))

    numbered = sliced.drop("_cuts").withColumns(
        {f"_own_{n}": F.sum(c).over(until) for n, c in sums.items()} | {"_own": F.row_number().over(inside)}
    )
    placed = numbered.join(before, [key, "_slice"], "left")
    return placed.withColumns(
        {n: with_offset(f"_{n}", F.col(f"_own_{n}")) for n in sums}
        | {name: with_offset("_rows", F.col("_own")).cast("int")}
    ).drop("_slice", "_own", *total, *(f"_own_{n}" for n in sums))


def number_within(
    df: DataFrame, key: str, order: list[str], name: str = "position", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Add `name`: 1, 2, … within `key` by `order`."""
    return running_within(df, key, order, {}, name, slice_rows)
