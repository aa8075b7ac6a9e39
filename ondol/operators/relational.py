"""Relational operators of the pipeline as compositions of DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row with the largest order of each key, by one partial aggregate."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def top_per_key(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each key; Spark keeps n rows a key and task before the shuffle."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_k") <= n).drop("_k")


def unmatched(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other.select(*keys), keys, "left_anti")


def split_by_reference(df: DataFrame, other: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key exists, rows whose key is missing); a NULL key is missing."""
    return df.join(other.select(*keys), keys, "left_semi"), unmatched(df, other, keys)


def differences(named: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(label, name): of each pair of one-column frames the names that the second lacks."""
    out = None
    for label, (a, b) in named.items():
        one = a.toDF("name").exceptAll(b.toDF("name")).distinct().select(F.lit(label).alias("label"), "name")
        out = one if out is None else out.unionByName(one)
    return out


def window_pairs(df: DataFrame, block: list[str], day: str, order: str, days: int, keep: list[str], slice_rows: int | None = None) -> DataFrame:
    """Pairs a, b of a block with order a < b and at most ``days`` days between them, by ranges of days: each row meets only the
    rows of its own and the two neighbouring ranges. With ``slice_rows`` the rows of a range of a block are met in slices of about
    as many, so that a hot block is spread over tasks."""
    slot = F.floor(F.datediff(F.col(day), F.lit("1970-01-01").cast("date")) / days)
    cols = list(dict.fromkeys([*block, day, order, *keep]))
    a = df.select(*[F.col(c).alias(f"a_{c}") for c in cols], F.explode(F.array(slot - 1, slot, slot + 1)).alias("_s"))
    b = df.select(*[F.col(c).alias(f"b_{c}") for c in cols], slot.alias("_t"))
    on = F.col("_s") == F.col("_t")
    for c in block:
        on = on & (F.col(f"a_{c}") == F.col(f"b_{c}"))
    near = (F.col(f"a_{order}") < F.col(f"b_{order}")) & (F.abs(F.datediff(F.col(f"a_{day}"), F.col(f"b_{day}"))) <= days)
    if slice_rows:
        keys = [f"b_{c}" for c in block]
        sizes = b.groupBy(*keys, "_t").agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("int").alias("_n"))
        large = sizes.where("_n > 1").withColumnsRenamed({k: f"_{k}" for k in keys}).withColumnRenamed("_t", "_of")
        of = F.lit(True)
        for k in keys:
            of = of & (F.col(k) == F.col(f"_{k}"))
        drop = [*[f"_{k}" for k in keys], "_of", "_n"]
        b = b.join(large, of & (F.col("_t") == F.col("_of")), "left").withColumn("_y", F.pmod(F.xxhash64(f"b_{order}"), F.coalesce("_n", F.lit(1))).cast("int")).drop(*drop)
        of = F.lit(True)
        for c in block:
            of = of & (F.col(f"a_{c}") == F.col(f"_b_{c}"))
        a = a.join(large, of & (F.col("_s") == F.col("_of")), "left").withColumn("_x", F.explode(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1))).drop(*drop)
        on = on & (F.col("_x") == F.col("_y"))
    return a.join(b, on & near).drop("_s", "_t", "_x", "_y")


def until_first_stale(pages: DataFrame, group: list[str], page: str, stale: Column) -> DataFrame:
    """The rows of all pages up to the first page that holds a stale row, that page included."""
    first = pages.where(stale).groupBy(*group).agg(F.min(page).alias("_first"))
    return pages.join(first, group, "left").where(F.col("_first").isNull() | (F.col(page) <= F.col("_first"))).drop("_first")


def rolling_average(df: DataFrame, group: list[str], order: str, value: str, n: int = 5) -> DataFrame:
    """Adds ``average`` of the previous n rows of a group, NULL without any."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(-n, -1)
    return df.withColumn("average", F.avg(value).over(w))


def numbered(df: DataFrame, group: list[str], coarse: Column, *order: Column) -> DataFrame:
    """Adds ``number``, the 1-based rank of a row in its group by descending ``coarse`` (NULL last), then by ``order``. Only the rows
    of one group and one coarse value are sorted together: the rows before them come from counts, so that a group of any size is
    spread over its coarse values."""
    keyed = df.withColumn("_c", coarse)
    sizes = keyed.groupBy(*group, "_c").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy(F.desc_nulls_last("_c")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumnsRenamed({c: f"_g_{c}" for c in [*group, "_c"]}).drop("_n")
    inside = keyed.withColumn("_k", F.row_number().over(Window.partitionBy(*group, "_c").orderBy(*order)))
    on = F.lit(True)
    for c in [*group, "_c"]:
        on = on & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return inside.join(sizes, on).withColumn("number", F.col("_before") + F.col("_k")).drop("_c", "_k", "_before", *[f"_g_{c}" for c in [*group, "_c"]])
