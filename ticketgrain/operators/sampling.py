"""Splitting, head, seeded samples and review templates.

Randomness is the order of ``md5(id, seed)``: repeatable on any cluster, the same
after an executor is lost, and independent of partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketgrain.operators.scaling import lookup_join, require_columns, stage

_HEX_DIGITS = 4  # 65,536 buckets per stratum


def sample_order(row_id: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f"-{seed}")))


def _largest_remainder(strata: DataFrame, label: str, size: str, draws: Column, name: str) -> DataFrame:
    """Share ``draws`` over the strata in proportion to ``size``; leftovers by remainder, then label.

    Its windows run over the strata: a row for each class, whatever the table holds.
    """
    everything = Window.partitionBy()
    exact = F.col(size) * draws / F.sum(size).over(everything)
    shares = strata.withColumn("_floor", F.floor(exact)).withColumn("_rest", exact - F.col("_floor"))
    rank = F.row_number().over(Window.orderBy(F.desc("_rest"), F.asc(label)))
    missing = draws - F.sum("_floor").over(everything)
    quota = F.col("_floor") + F.when(rank <= missing, 1).otherwise(0)
    return shares.withColumn(name, quota.cast("long")).drop("_floor", "_rest")


def split_quotas(
    df: DataFrame, stratify_by: str, test_size: float = 0.3, second_size: float = 0.5
) -> DataFrame:
    """Rows of each stratum that go to train, val and test."""

    def kept(size: str, share: float) -> Column:
        total = F.sum(size).over(Window.partitionBy())
        return total - F.ceil(total * share)

    strata = df.groupBy(stratify_by).agg(F.count(F.lit(1)).alias("n")).withColumn("_draws", kept("n", test_size))
    first = _largest_remainder(strata, stratify_by, "n", F.col("_draws"), "n_train")
    first = first.withColumn("_held", F.col("n") - F.col("n_train")).withColumn("_draws", kept("_held", second_size))
    second = _largest_remainder(first, stratify_by, "_held", F.col("_draws"), "n_val")
    quotas = stage(
        second.select(stratify_by, "n", "n_train", "n_val", (F.col("_held") - F.col("n_val")).alias("n_test"))
    )
    if not quotas.filter(F.col("n") < 2).isEmpty():
        raise ValueError("every class needs at least two rows to be split")
    return quotas


def stratified_split(
    df: DataFrame,
    row_id: str,
    stratify_by: str = "queue",
    test_size: float = 0.3,
    second_size: float = 0.5,
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` (train/val/test) with exact per-stratum sizes.

    Rows of a stratum are taken in hash order.  Instead of ranking a stratum (one
    may hold a third of the table), the hash values at the two cuts are found:
    count rows per hash prefix, see which prefix each cut falls into, and rank
    only the rows of those prefixes.  The split itself is then a comparison
    against a table with one row per stratum, so the rows are never shuffled.
    """
    require_columns(df, [row_id, stratify_by])
    columns, stratum = df.columns, "_stratum"
    # Null is a stratum of its own, distinct from every text.
    label = F.concat(F.lit("="), F.col(stratify_by).cast("string"))
    df = df.withColumn(stratum, F.coalesce(label, F.lit("")))
    quotas = split_quotas(df, stratum, test_size, second_size)

    keyed = df.select(stratum, sample_order(row_id, seed).alias("_hash")).withColumn(
        "_bucket", F.substring("_hash", 1, _HEX_DIGITS)
    )
    buckets = keyed.groupBy(stratum, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    running = Window.partitionBy(stratum).orderBy("_bucket")
    buckets = buckets.withColumn("_upto", F.sum("_rows").over(running)).withColumn(
        "_before", F.col("_upto") - F.col("_rows")
    )
    cuts = quotas.select(
        stratum,
        F.inline(
            F.array(
                F.struct(F.lit("train").alias("_cut"), F.col("n_train").alias("_at")),
                F.struct(F.lit("val").alias("_cut"), (F.col("n_train") + F.col("n_val")).alias("_at")),
            )
        ),
    )
    # The bucket that holds the last row before each cut (a cut at 0 has none).
    cut_buckets = stage(
        buckets.join(cuts, stratum)
        .filter((F.col("_before") < F.col("_at")) & (F.col("_at") <= F.col("_upto")))
        .select(stratum, "_bucket", "_cut", (F.col("_at") - F.col("_before")).alias("_nth"))
    )
    wanted = cut_buckets.select(stratum, "_bucket").distinct()
    inside = lookup_join(keyed, wanted, [stratum, "_bucket"], "inner")
    place = F.row_number().over(Window.partitionBy(stratum, "_bucket").orderBy("_hash"))
    limits = (
        inside.withColumn("_nth", place)
        .join(cut_buckets, [stratum, "_bucket", "_nth"])
        .groupBy(stratum)
        .agg(
            F.max(F.when(F.col("_cut") == "train", F.col("_hash"))).alias("_train_upto"),
            F.max(F.when(F.col("_cut") == "val", F.col("_hash"))).alias("_val_upto"),
        )
    )
    order = sample_order(row_id, seed)
    split = (
        F.when(order <= F.coalesce("_train_upto", F.lit("")), F.lit("train"))
        .when(order <= F.coalesce("_val_upto", F.lit("")), F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return (
        lookup_join(df, limits, [stratum], "left")
        .withColumn("split", split)
        .drop("_train_upto", "_val_upto")
        .select(*columns, "split")
    )


def head(df: DataFrame, n: int, row_id: str) -> DataFrame:
    """The n rows with the smallest ids, in no order; null ids come first.

    See ``first_by_key``.  Of other ids than whole numbers each task sends its n smallest to one, ids
    only; with ids of several fields (structs) the rows go with them.
    """
    kind = df.schema[row_id].dataType
    if not isinstance(kind, T.AtomicType):
        return df.orderBy(row_id).limit(n)
    if isinstance(kind, T.IntegralType):
        return first_by_key(df, n, F.coalesce(F.col(row_id).cast("long"), F.lit(-(2**63))), F.col(row_id).isNotNull().cast("int"))
    last = df.select(row_id).orderBy(row_id).limit(n).agg(F.max(row_id), F.count(F.lit(1)), F.count(row_id)).first()
    if last[1] < n:
        return df
    return _up_to(df, n, F.col(row_id) < F.lit(last[0]), F.col(row_id).eqNullSafe(F.lit(last[0])), F.col(row_id).isNull() & (last[2] > 0))


def random_sample(df: DataFrame, n: int, row_id: str, seed: int = 42) -> DataFrame:
    """n rows drawn without replacement, in no order; all rows when there are fewer.

    The draw goes by a hash of the id: its first 60 bits as a number, then the rest of its text.
    """
    order = sample_order(row_id, seed)
    key = F.coalesce(F.conv(F.substring(order, 1, 15), 16, 10).cast("long"), F.lit(-1).cast("long"))  # null ids first
    return first_by_key(df, n, key, F.coalesce(F.concat(order, F.col(row_id).cast("string")), F.lit("")))


# Keys are counted in so many steps when a cut is looked for, and a step is cut again while it holds more rows than this.
_STEPS, _ENOUGH = 1024, 4096


def first_by_key(df: DataFrame, n: int, key: Column, tie: Column) -> DataFrame:
    """The n rows with the smallest (key, tie); ``key`` is a long without nulls.

    The n-th key is found from histograms of the keys (each a bounded number of rows), refined in the
    step where the n-th row lies.  Rows are then filtered where they are: no row travels.
    """
    keys = df.select(key.alias("k"), tie.alias("t"))
    low, high, total = keys.agg(F.min("k"), F.max("k"), F.count(F.lit(1))).first()
    if n <= 0:
        return df.limit(0)
    if total <= n:
        return df
    below, inside = 0, total
    while high > low and inside > _ENOUGH:
        width = -(-(high - low + 1) // _STEPS)
        # decimals hold the distance of any two longs
        step = F.floor((F.col("k").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
        counts = keys.filter(F.col("k").between(low, high)).groupBy(step.cast("int").alias("s")).count().collect()
        for s, rows in sorted(tuple(c) for c in counts):
            if below + rows >= n:
                low, high, inside = low + s * width, min(high, low + (s + 1) * width - 1), rows
                break
            below += rows
    k, t = (
        keys.filter(F.col("k").between(low, high)).orderBy("k", "t").limit(n - below).agg(F.max(F.struct("k", "t")).alias("m")).select("m.*").first()
    )
    return _up_to(df, n, (key < F.lit(k)) | ((key == F.lit(k)) & (tie < F.lit(t))), (key == F.lit(k)) & (tie == F.lit(t)))


def _up_to(df: DataFrame, n: int, before: Column, last: Column, also: Column | None = None) -> DataFrame:
    """Rows before the last place, and as many of those equal to it as are wanted: the smallest by all their columns."""
    before = before if also is None else F.coalesce(before, F.lit(False)) | also
    counted = df.agg(F.count_if(before), F.count_if(last)).first()
    if counted[0] + counted[1] <= n:
        return df.filter(before | last)
    # maps and variants have no order
    sortable = [F.col(f"`{f.name}`") for f in df.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    return df.filter(before).unionByName(df.filter(last).orderBy(*sortable).limit(n - counted[0]))


def holdout(df: DataFrame, row_id: str, val_size: float = 0.05, seed: int = 42) -> DataFrame:
    """Mark about ``val_size`` of the rows as 'val' by their hash, the rest as 'train'."""
    limit = f"{int(val_size * 16**8):08x}"
    prefix = F.substring(sample_order(row_id, seed), 1, 8)
    return df.withColumn("part", F.when(prefix < limit, F.lit("val")).otherwise(F.lit("train")))


def review_template(
    df: DataFrame,
    row_id: str,
    n_samples: int = 100,
    columns: Sequence[str] = ("input", "reference", "prediction"),
    chars: int = 500,
) -> DataFrame:
    """First n rows numbered from 1 with cut texts and empty rating columns."""
    blank = [F.lit("").alias(c) for c in (
        "relevance", "professionalism", "completeness", "tone", "overall", "comments"
    )]
    cut = df.select(
        row_id, *[F.substring(F.coalesce(F.col(c), F.lit("")), 1, chars).alias(c) for c in columns]
    )
    # At most n_samples rows reach the numbering window.
    picked = head(cut, n_samples, row_id)
    number = F.row_number().over(Window.orderBy(row_id)).cast("long").alias("id")
    return picked.select(number, *columns, *blank)
