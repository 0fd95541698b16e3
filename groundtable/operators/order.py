"""Places in an order, over tables of any size: exact quantiles and dense numbers without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundtable.session import stored

#: Marks of quantiles are off by a share of 1 / ACCURACY of a group's rows at most.
ACCURACY = 10_000


def quantiles(df: DataFrame, groups: list[str], value: str, shares: tuple[float, ...] = (0.5,), accuracy: int = ACCURACY) -> DataFrame:
    """The groups with n, mean, least, most and q0, q1, ...: the exact quantiles at `shares`, interpolated between neighbours.

    Two passes over `df`. The first gives each group, from mergeable sketches, two marks that surely enclose each quantile. The second
    counts what lies below the marks (one number a task and group) and the values between them by value: 4 / accuracy of
    a group's rows (all of them in a group of at most 2 * accuracy), in whose running counts the quantile's neighbours are found. So no task ever has a group's values, and no row is sorted
    or shuffled that is not between marks. Nulls and NaN do not count; a group without other values is left out, and a null group is a group.
    """
    names = [f"g{i}" for i in range(len(groups))] or ["g0"]
    rows = df.select(*([F.col(g).alias(n) for g, n in zip(groups, names, strict=True)] if groups else [F.lit(0).alias("g0")]), F.col(value).cast("double").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    around = [x for q in shares for x in (max(0.0, q - 2 / accuracy), min(1.0, q + 2 / accuracy))]
    marks = rows.groupBy(*names).agg(
        F.percentile_approx("v", [*around], accuracy).alias("marks"), F.count("v").alias("n"), F.avg("v").alias("mean"), F.min("v").alias("least"), F.max("v").alias("most"),
    )
    marks = stored(marks, "marks")  # a file's size tells Spark whether it can be broadcast
    many = F.col("n") > 2 * accuracy  # of fewer rows all are between the marks: rounded ranks of neighbours might not be
    lo = [F.when(many & F.lit(x > 0), F.col("marks")[k]).otherwise(F.col("least")) for k, x in enumerate(around)][::2]
    hi = [F.when(many & F.lit(x < 1), F.col("marks")[k]).otherwise(F.col("most")) for k, x in enumerate(around)][1::2]
    beside = with_marks(rows, marks, names)
    if len(shares) == 1:
        seen = beside.filter(F.col("v") <= hi[0]).withColumns({"i": F.lit(0), "x": F.when(F.col("v") >= lo[0], F.col("v"))})
    else:
        near = [F.when(F.col("v") <= b, F.struct(F.lit(i).alias("i"), F.when(F.col("v") >= a, F.col("v")).alias("x"))) for i, (a, b) in enumerate(zip(lo, hi, strict=True))]
        seen = beside.select("*", F.inline(F.array_compact(F.array(*near))))
    same = [F.max(c).alias(c) for c in ("n", "mean", "least", "most")]
    counted = seen.groupBy(*names, "i", "x").agg(F.count(F.lit(1)).alias("c"), *same)
    run = Window.partitionBy(*names, "i").orderBy(F.col("x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    place = (F.col("n") - 1) * F.element_at(F.array(*map(F.lit, shares)), F.col("i") + 1)
    held = counted.withColumn("upto", F.sum("c").over(run)).withColumns({"place": place, "from": F.col("upto") - F.col("c")})
    at = lambda rank: F.max(F.when(F.col("x").isNotNull() & (F.col("from") <= rank) & (rank < F.col("upto")), F.col("x")))
    found = held.groupBy(*names, "i").agg(*same, F.max("place").alias("place"), at(F.floor("place")).alias("a"), at(F.ceil("place")).alias("b"))
    q = F.when(F.floor("place") == F.ceil("place"), F.col("a")).otherwise((F.ceil("place") - F.col("place")) * F.col("a") + (F.col("place") - F.floor("place")) * F.col("b"))
    q = F.coalesce(q, F.raise_error(F.lit("a quantile lies outside its marks")).cast("double"))
    wide = found.withColumn("q", q).groupBy(*names).agg(*same, *(F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(len(shares))))
    return wide.select(*(F.col(n).alias(g) for g, n in zip(groups, names, strict=False)), "n", "mean", "least", "most", *(f"q{i}" for i in range(len(shares))))


def with_marks(rows: DataFrame, marks: DataFrame, names: list[str]) -> DataFrame:
    """`rows` beside their group's marks, null groups too."""
    other = marks.withColumnsRenamed({n: f"_{n}" for n in names})
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_{n}"))
    return rows.join(other, same)


def numbered(df: DataFrame, order: list[str], name: str = "nth") -> DataFrame:
    """`df` with dense numbers from 0 in `order`: rows are dealt by ranges, and a row's number is what all ranges before hold and its place in its own."""
    rows = stored(df, "unnumbered")
    ranged = rows.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
    rows = stored(ranged.withColumn("_part", F.spark_partition_id()), "ranged")  # ranges are drawn anew each time, so they are written once
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return rows.withColumn("_in", F.row_number().over(inside)).join(starts, "_part").select(*df.columns, (F.col("_start") + F.col("_in") - 1).cast("long").alias(name))
