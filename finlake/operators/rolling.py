"""Rolling means over the last rows of a group, for groups of any size.

A window over one group is one task. Here a group is cut, in its order, into
buckets of bounded size, and each bucket also gets the few rows before it that its first
rows look back to, so each task sees the complete frame of its rows. Rows are read
once for the counts of their days and once for the means.

Buckets are made of units: a day, or a part of a large day. The bounds of the parts are
quantiles of the day's row numbers from a sketch of bounded size, so outliers do not matter,
and the rows of each part are counted, so the sketch's error does not either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from finlake.operators.periods import null_safe_left_join
from finlake.sources import files

BUCKET, LATER = "__bucket", "__later"
_CARRIED = "__carried"
ROWS_PER_BUCKET = 1_000_000
# A day with more than this share of a bucket is cut into that many parts, at most.
CUT_SHARE, PARTS, _COARSE = 16, 256, 16
ACCURACY = 20_000

# Columns of a placed day that tell the buckets of its rows.
PLACE = ["__bounds", "__places"]


def day_counts(rows: DataFrame, group: list[str], day: str) -> DataFrame:
    """Row count of each group and day."""
    return rows.groupBy(*group, day).agg(F.count(F.lit(1)).alias("__n"))


def part_of(number: str) -> Column:
    """Part of a row in its day: how many of the sorted bounds are below its number.

    Every sixteenth bound is compared first, then the ones up to the next.
    """
    steps = F.size("__bounds") / F.lit(_COARSE)
    every = F.transform(
        F.sequence(F.lit(1), F.greatest(F.floor(steps).cast("int"), F.lit(1))),
        lambda k: F.get("__bounds", k * _COARSE - 1),
    )
    below = F.size(F.filter(every, lambda b: b < F.col(number))) * _COARSE
    rest = F.slice("__bounds", below + 1, F.lit(_COARSE))
    found = below + F.size(F.filter(rest, lambda b: b < F.col(number)))
    return F.when(F.col("__bounds").isNull() | F.col(number).isNull(), F.lit(0)).otherwise(found)


def cut_days(
    rows: DataFrame,
    large: DataFrame,
    group: list[str],
    day: str,
    number: str,
    rows_per_part: int,
    work: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Bounds of large days, and the counts of their parts; scans the rows of those days twice.

    ``large`` tells each day's ``__n``: it gets a part per ``rows_per_part``, at most PARTS.
    """
    keys = [*group, day]
    narrow = rows.select(*keys, number)
    days = large.select(*keys, F.least(F.ceil(F.col("__n") / rows_per_part), F.lit(PARTS)).cast("int").alias("__cuts"))
    of_large = null_safe_left_join(narrow, days, keys, *keys, number, "__cuts").where("__cuts is not null")
    fractions = F.array(*[F.lit(k / PARTS) for k in range(1, PARTS)])
    quantiles = F.percentile_approx(F.col(number).cast("bigint"), fractions, ACCURACY)
    found = of_large.groupBy(*keys).agg(quantiles.alias("__quantiles"), F.max("__cuts").alias("__cuts"))
    # Of all quantiles, those of as many even parts.
    even = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("__cuts") - 1, F.lit(1))),
        lambda k: F.get("__quantiles", F.floor(k * PARTS / F.col("__cuts")).cast("int") - 1),
    )
    # A day without any number is one part.
    cuts = F.coalesce(F.array_sort(F.array_distinct(F.array_compact(even))), F.array().cast("array<bigint>"))
    bounds = found.select(*keys, cuts.alias("__bounds"))
    bounds = files.hold(bounds, "rolling-bounds", work)
    parts = null_safe_left_join(narrow, bounds, keys, *keys, number, "__bounds").where("__bounds is not null")
    counts = parts.groupBy(*keys, part_of(number).alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    return bounds, files.hold(counts, "rolling-parts", work)


def place_days(
    counts: DataFrame,
    rows: DataFrame,
    group: list[str],
    day: str,
    number: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    frame: int = 4,
    work: str | None = None,
) -> DataFrame:
    """For each group and day of ``counts`` the columns PLACE.

    ``__places`` maps each part of the day to its bucket and to the later buckets whose first
    rows look back to it, within a frame of that many rows. ``counts`` (group, day, ``__n``) should be
    stored: whether there are large days is looked up now, and ``rows`` is only read if so.
    The windows run over one row per unit, not over the data.
    """
    keys = [*group, day]
    # Parts of half that size: a part that a later bucket looks back to is carried whole.
    rows_per_part = max(rows_per_bucket // CUT_SHARE, 1)
    large = F.col("__n") > rows_per_part
    units = counts.select(*keys, F.lit(0).alias("__part"), "__n")
    bounds = None
    if not counts.where(large).isEmpty():
        bounds, parts = cut_days(rows, counts.where(large), group, day, number, max(rows_per_part // 2, 1), work)
        units = units.where(~large).unionByName(parts)
    ordered = Window.partitionBy(*group).orderBy(F.col(day).asc_nulls_first(), "__part")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    units = units.withColumn(BUCKET, F.floor(F.col("__before") / F.lit(rows_per_bucket)).cast("bigint"))
    after = []
    for k in range(1, frame):
        # Every unit has a row, so what looks back to this unit is among the next frame - 1 ones.
        near = F.lead("__before", k).over(ordered) - F.col("__before") - F.col("__n") <= frame - 2
        after.append(F.when(near & (F.lead(BUCKET, k).over(ordered) > F.col(BUCKET)), F.lead(BUCKET, k).over(ordered)))
    later = F.array_distinct(F.array_compact(F.array(*after))) if after else F.array().cast("array<bigint>")
    places = units.select(*keys, "__part", F.struct(BUCKET, later.alias(LATER)).alias("__place"))
    places = places.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("__part", "__place"))).alias("__places")
    )
    if bounds is None:
        return places.withColumn("__bounds", F.lit(None).cast("array<bigint>"))
    return null_safe_left_join(places, bounds, keys, *keys, "__bounds", "__places")


def bucket_columns(number: str) -> list[Column]:
    """Bucket of a row that carries the columns of its placed day, and the later ones that need it."""
    place = F.element_at("__places", part_of(number))
    return [place[BUCKET].alias(BUCKET), place[LATER].alias(LATER)]


def with_buckets(
    rows: DataFrame,
    group: list[str],
    day: str,
    number: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    frame: int = 4,
) -> DataFrame:
    """Rows with their bucket number and the later buckets whose frames of so many rows reach them."""
    counts = files.hold(day_counts(rows, group, day), "rolling-days")
    days = place_days(counts, rows, group, day, number, rows_per_bucket, frame)
    kept = [F.col(name) for name in rows.columns]
    return null_safe_left_join(rows, days, [*group, day], *kept, *bucket_columns(number))


def rolling_means(
    bucketed: DataFrame, group: list[str], day: str, number: str, means: dict[str, str], rows: int = 4
) -> DataFrame:
    """Means over each row and the ``rows - 1`` before it, by (day, number) in a group.

    ``bucketed`` comes from :func:`with_buckets` with a frame of at least ``rows``; ``means`` maps
    each output to its input column; nulls do not count. The bucket columns are dropped.
    """
    kept = [name for name in bucketed.columns if name not in (BUCKET, LATER)]
    order = [F.col(day).asc_nulls_first(), F.col(number).asc_nulls_first()]
    seen_in = F.explode(F.concat(F.array(BUCKET), F.col(LATER))).alias("__bucket_of_frame")
    spread = bucketed.select("*", seen_in).withColumn(_CARRIED, F.col("__bucket_of_frame") != F.col(BUCKET))
    frame = (
        Window.partitionBy(*group, "__bucket_of_frame").orderBy(*order).rowsBetween(1 - rows, Window.currentRow)
    )
    return (
        spread.select(*kept, _CARRIED, *(F.avg(value).over(frame).alias(name) for name, value in means.items()))
        .where(~F.col(_CARRIED))
        .select(*kept, *means)
    )
