"""Ordered work within a key when one key may hold a third of all rows.

A window ``PARTITION BY key`` puts a whole key into one task.  Here a key with
more than ``rows_per_slice`` rows is cut into ordered slices first, each slice is
worked on by itself, and only the few rows a frame needs from its neighbours
travel along.  Keys below the limit stay whole, so an input without heavy keys
costs one extra count over the key column and nothing else: adaptive execution
drops the branches that turn out empty.

What is broadcast is bounded: at most ``rows / rows_per_slice`` heavy keys, with
about one cut point per ``rows_per_slice`` rows in all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlens.schemas import quoted

ROWS_PER_SLICE = 8_000_000
_OVERSAMPLE = 16
_SEARCH_STEPS = [1 << s for s in range(29, -1, -1)]


def _look_up(df: DataFrame, small: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Join a bounded table on the key; rows without a key are one group like any other."""
    names = {k: f"__key{i}" for i, k in enumerate(key)}
    small = small.withColumnsRenamed(names)
    same = reduce(and_, [F.col(quoted(k)).eqNullSafe(F.col(n)) for k, n in names.items()])
    return df.join(F.broadcast(small), same, how).drop(*names.values())


def _point(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def cut_points(df: DataFrame, key: Sequence[str], order: Sequence[str], rows_per_slice: int) -> DataFrame:
    """``(key, __slice, __point)`` for the heavy keys: the position at which each slice from 1 on starts.

    The positions come from a sample chosen by hash, so every run and every
    retried task sees the same cuts.  The sample only places the cuts; no row
    depends on it for its result.
    """
    share = min(1.0, _OVERSAMPLE / rows_per_slice)
    picked = F.shiftrightunsigned(F.xxhash64(*key, *order), 33) < F.lit(int(share * 2**31))
    sample = df.select(*key, *order).filter(picked)
    if key:
        sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > rows_per_slice)
        sample = _look_up(sample, sizes.select(*key), key, "inner")
    place = F.row_number().over(Window.partitionBy(*key).orderBy("__point"))
    return (
        sample.select(*key, _point(order).alias("__point")).distinct()
        .withColumn("__place", place)
        .filter(F.col("__place") % _OVERSAMPLE == 0)
        .select(*key, F.floor(F.col("__place") / _OVERSAMPLE).cast("int").alias("__slice"), "__point")
    )


def _slice_number(order: Sequence[str]) -> Column:
    """How many of a key's cuts in the list of all lie at or below the row's position, by binary search."""
    first, n = F.coalesce("__first", F.lit(0)), F.col("__n")
    steps = F.array(*[F.lit(s) for s in _SEARCH_STEPS])

    def search(told: Column) -> Column:
        def step_over(done: Column, step: Column) -> Column:
            reached = F.get(told["cuts"], first + done + step - 1)
            return F.when((done + step <= n) & (reached <= told["here"]), done + step).otherwise(done)

        return F.aggregate(steps, F.lit(0), step_over)

    # The list is named once, right above a join, so Spark folds it into this expression; as a column it would be copied into every row.
    told = F.array(F.struct(F.col("__cuts").alias("cuts"), _point(order).alias("here")))
    return F.when(n > 0, F.get(F.transform(told, search), 0)).otherwise(0)


def with_slices(df: DataFrame, cuts: DataFrame, key: Sequence[str], order: Sequence[str], heavy_only: bool = False) -> DataFrame:
    """Add ``__slice``; 0 for every row of a light key.  Without a key the whole table is cut.

    All cuts are one list, which tasks share, by key and point; a row carries only the place and number of its key's cuts,
    so what a row costs grows with the logarithm of the cuts.
    """
    points = F.array_sort(F.collect_list(F.struct(*key, "__point")))
    every = cuts.agg(F.transform(points, lambda p: p["__point"])).scalar()
    if key:
        earlier = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
        places = cuts.groupBy(*key).agg(F.count(F.lit(1)).cast("int").alias("__n")).withColumn(
            "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).cast("int")
        )
        joined = _look_up(df, places, key, "inner" if heavy_only else "left")
    else:
        joined = df.crossJoin(F.broadcast(cuts.agg(F.count(F.lit(1)).cast("int").alias("__n"), F.max(F.lit(0)).alias("__first"))))
    return joined.withColumn("__cuts", every).withColumn("__slice", _slice_number(order)).select(*map(quoted, df.columns), "__slice")


def ordered_window(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    lookback: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``build(window)`` columns whose frames reach at most ``lookback`` rows back.

    ``window`` is partitioned by key and ordered by ``order``, which should be a
    total order.  Equal to the plain window over the same spec.
    """
    cuts = cut_points(df, key, order, rows_per_slice)
    columns = df.columns

    last_first = Window.partitionBy(*key, "__slice").orderBy(*[F.col(c).desc_nulls_last() for c in order])
    tails = (
        with_slices(df, cuts, key, order, heavy_only=True)
        .withColumn("__back", F.row_number().over(last_first))
        .filter(F.col("__back") <= lookback)
    )
    # A tail goes to the next slice, and beyond it only where the slices between hold too few rows.
    along = Window.partitionBy(*key).orderBy("__slice")
    told = (
        tails.groupBy(*key, "__slice").agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__upto", F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("__before", F.col("__upto") - F.col("__n"))
    )
    after = F.collect_list(F.struct(F.col("__slice").alias("__to"), "__before")).over(along.rowsBetween(1, max(lookback, 1)))
    routes = (
        told.select(*key, "__slice", "__upto", after.alias("__after"))
        .select(*key, "__slice", "__upto", F.inline("__after"))
        .select(*key, "__slice", "__to", (F.lit(lookback) + F.col("__upto") - F.col("__before")).alias("__room"))
        .filter(F.col("__room") > 0)
    )
    halo = (
        _look_up(tails, routes, [*key, "__slice"], "inner")
        .filter(F.col("__back") <= F.col("__room"))
        .select(*map(quoted, columns), F.col("__to").alias("__slice"), F.lit(True).alias("__halo"))
    )
    rows = with_slices(df, cuts, key, order).withColumn("__halo", F.lit(False)).unionByName(halo)
    window = Window.partitionBy(*key, "__slice").orderBy(*order)
    made = build(window)
    kept = [c for c in columns if c not in made]
    return (
        rows.select(*map(quoted, kept), "__halo", *[c.alias(n) for n, c in made.items()])
        .filter(~F.col("__halo"))
        .drop("__halo")
    )


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int, salts: int = 1024) -> DataFrame:
    """The first ``n`` rows of each key in the given total order.

    Small ``n`` is cut down before the shuffle by Spark's own group limit.  That
    stops at 1000 rows, so beyond it the rows are cut down per salt first; the
    second step sees at most ``salts * n`` rows of a key.
    """
    if n > 1000:
        salt = F.pmod(F.xxhash64(*map(quoted, df.columns)), F.lit(salts))
        spread = Window.partitionBy(*key, "__salt").orderBy(*order)
        df = (
            df.withColumn("__salt", salt)
            .withColumn("__rank", F.row_number().over(spread))
            .filter(F.col("__rank") <= n)
            .drop("__salt", "__rank")
        )
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter(F.col("__rank") <= n).drop("__rank")


def smallest_digests(df: DataFrame, key: Sequence[str], digest: str, n: int) -> DataFrame:
    """The ``n`` rows of each key with the smallest hexadecimal digests; equal digests go by the other columns.

    Rows are counted by the first four digits, which tells the digits of a key's n-th row.  Only rows up to those
    digits go on: about ``n`` and a 65536th of the key's rows.  Equal rows travel and are ranked as one with a count.
    """
    columns = df.columns
    digits = F.substring(digest, 1, 4)
    along = Window.partitionBy(*key).orderBy("__digits").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        df.groupBy(*key, digits.alias("__digits")).agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__upto", F.sum("__n").over(along))
        .filter((F.col("__upto") >= n) & (F.col("__upto") - F.col("__n") < n))
        .select(*[F.col(quoted(k)).alias(f"__key{i}") for i, k in enumerate(key)], F.col("__digits").alias("__last"))
    )
    same = reduce(and_, [F.col(quoted(k)).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(key)])
    order = [quoted(c) for c in columns if c not in (*key, digest)]
    so_far = Window.partitionBy(*key).orderBy(quoted(digest), *order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(last, same, "left")
        .filter(F.col("__last").isNull() | (digits <= F.col("__last")))
        .groupBy(*map(quoted, columns)).agg(F.count(F.lit(1)).alias("__copies"))
        .withColumn("__left", F.lit(n) - F.coalesce(F.sum("__copies").over(so_far), F.lit(0)))
        .filter(F.col("__left") > 0)
        .select(*map(quoted, columns), F.explode(F.sequence(F.lit(1).cast("long"), F.least("__copies", "__left"))).alias("__copy"))
        .drop("__copy")
    )


def ranked(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    weight: str | None = None,
) -> DataFrame:
    """Add ``__rank`` (from 1) and ``__size`` within each key, without holding a heavy key in one task.

    With ``weight`` a row stands for that many rows: its rank is that of its last one.
    """
    weigh = F.col(weight) if weight else F.lit(1)
    cuts = cut_points(df, key, order, rows_per_slice)
    # Slices per heavy key are as few as its cuts, so this window and its broadcast are small.
    earlier = Window.partitionBy(*key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        with_slices(df, cuts, key, order, heavy_only=True)
        .groupBy(*key, "__slice")
        .agg(F.sum(weigh).alias("__n"))
        .select(
            *key, "__slice",
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"),
            F.sum("__n").over(Window.partitionBy(*key)).alias("__total"),
        )
    )
    within = Window.partitionBy(*key, "__slice")
    so_far = within.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        with_slices(df, cuts, key, order)
        .withColumn("__upto", F.sum(weigh).over(so_far))
        .withColumn("__whole", F.sum(weigh).over(within))
        .transform(_look_up, offsets, [*key, "__slice"], "left")
        .select(
            *map(quoted, df.columns),
            (F.coalesce("__offset", F.lit(0)) + F.col("__upto")).alias("__rank"),
            F.coalesce("__total", "__whole").alias("__size"),
        )
    )


def row_index(df: DataFrame, order: Sequence[str], name: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Consecutive numbers from 0 over the whole table, in the given total order."""
    return ranked(df, [], order, rows_per_slice).select(*map(quoted, df.columns), (F.col("__rank") - 1).alias(name))


def interpolated_quantiles(
    df: DataFrame,
    key: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Exact quantiles, linear between neighbours, one column per name.

    ``percentile`` keeps every distinct value of a group in one buffer.  Here equal
    values are counted before the shuffle, heavy groups are sorted in slices, and
    only the rows at the wanted ranks are kept.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count(F.lit(1)).alias("__copies"))
    rows = ranked(counts, key, [value], rows_per_slice, weight="__copies")
    first, last = F.col("__rank") - F.col("__copies"), F.col("__rank") - 1  # places from 0
    parts, out, wanted = [], [], F.lit(False)
    for name, p in probabilities.items():
        spot = (F.col("__size") - 1) * F.lit(float(p))
        below, above = F.floor(spot).between(first, last), F.ceil(spot).between(first, last)
        wanted = wanted | below | above
        parts += [
            F.max(F.when(below, F.col(value))).alias(f"__low_{name}"),
            F.max(F.when(above, F.col(value))).alias(f"__high_{name}"),
            F.max(spot - F.floor(spot)).alias(f"__part_{name}"),
        ]
        low, high, part = (F.col(f"__{x}_{name}") for x in ("low", "high", "part"))
        out.append((low + (high - low) * part).alias(name))
    return rows.filter(wanted).groupBy(*key).agg(*parts).select(*key, *out)
