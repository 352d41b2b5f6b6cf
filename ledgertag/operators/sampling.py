"""Samples and splits by repeatable draws.

Every draw comes from a digest of the row and its copy number. The result does not depend on
partitioning or retries, and equal rows are drawn each on their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertag.functions.hashing import row_digest, unit_draw
from ledgertag.operators.copies import number_copies
from ledgertag.operators.reducers import KeySet, maybe_among, not_among
from ledgertag.session import BROADCAST_ROWS, bounded_side, materialize

FRACTION_SEED = 123
STRATUM_SEED = 42
SPLIT_SEED = 42
BUCKET_DIGITS = 3  # hexadecimal digits: 4,096 buckets per class, and as many again in each
DIGEST_DIGITS = 32
ROWS_PER_CUT = 1_000_000  # rows that one task sorts to find a cut
MAX_CLASSES = 1_000_000  # sizes of all classes are ranked in one task


HASH = "_row_hash"


def _counted_hashes(df: DataFrame, *more: Column) -> DataFrame:
    """How often each row hash occurs, with more aggregates of the rows. Narrow, and stored once."""
    hashed = F.xxhash64(*df.columns).alias(HASH)
    return materialize(df.groupBy(hashed).agg(F.count("*").alias("n"), *more))


def _with_copy_numbers(df: DataFrame, hashes: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows with numbers for equal ones, and the columns that tell any two of them apart.

    Only hashes that occur several times can belong to equal rows. Rows with another hash have number 1 and
    stay where they are; just the rest are counted and numbered, which shuffles all their columns.
    """
    repeated = hashes.where("n > 1").select(HASH)
    hashed = df.withColumn(HASH, F.xxhash64(*df.columns))
    among = KeySet(repeated, [HASH], hashed)
    single = not_among(hashed, among).drop(HASH).withColumn("copy_no", F.lit(1).cast("bigint"))
    identity = [*df.columns, "copy_no"]
    if not among.size:
        return single, identity
    several = number_copies(maybe_among(hashed, among).drop(HASH))
    return single.unionByName(several), identity


def sample_to_size(
    df: DataFrame, n_samples: int, key: list[str] | None = None, seed: int = FRACTION_SEED
) -> DataFrame:
    """Keep each row with probability min(n_samples / rows, 1).

    The frame is evaluated twice, to count and to draw. Without a unique ``key``, equal rows are numbered;
    no column of the others is shuffled or stored.
    """
    if key is not None:
        rows, identity, size = df, key, df.agg(F.count("*")).scalar()
    else:
        hashes = _counted_hashes(df)
        rows, identity = _with_copy_numbers(df, hashes)
        size = hashes.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    ratio = F.try_divide(F.lit(float(n_samples)), size)
    return rows.where(unit_draw(identity, seed) < ratio).select(*df.columns)


def stratum_ratios(
    df: DataFrame, n_samples: int, strata: list[str], counted: str
) -> DataFrame:
    """Per stratum: its size and the share of rows to keep, at most 1."""
    sizes = df.groupBy(*strata).agg(F.count(counted).alias("n_rows"))
    share = F.try_divide(F.lit(float(n_samples)), F.col("n_rows"))
    return sizes.withColumn("ratio", F.when(share >= 1, 1.0).otherwise(share))


def sample_per_stratum(
    df: DataFrame,
    n_samples: int,
    strata: list[str],
    counted: str,
    key: list[str] | None = None,
    seed: int = STRATUM_SEED,
) -> DataFrame:
    """Keep about ``n_samples`` rows of every stratum, and all rows of smaller strata.

    A missing value in a stratum column is a value of its own. The ratios are few and are sent
    to the rows, so no stratum is ever gathered in one place. Equal rows as in ``sample_to_size``.
    """
    rows, identity = (df, key) if key is not None else _with_copy_numbers(df, _counted_hashes(df))
    ratios = stratum_ratios(df, n_samples, strata, counted).select(
        *[F.col(c).alias(f"stratum_{c}") for c in strata], "ratio"
    )
    same = [F.col(c).eqNullSafe(F.col(f"stratum_{c}")) for c in strata]
    return (
        rows.join(bounded_side(ratios), same, "inner")
        .where(unit_draw(identity, seed) < F.col("ratio"))
        .select(*df.columns)
    )


def _shares(sizes: DataFrame, size: str, total: int, quota: str) -> DataFrame:
    """Divide ``total`` over classes by size: whole parts, then largest remainders."""
    everything = Window.partitionBy(F.lit(1))
    # Products of two row counts don't fit into 64 bits.
    product = f"CAST({total} AS DECIMAL(18, 0)) * CAST({size} AS DECIMAL(19, 0))"
    whole = F.expr(f"{product} div CAST(all_rows AS DECIMAL(19, 0))")
    rest = F.col("remainder")
    return (
        sizes.withColumn("all_rows", F.sum(size).over(everything))
        .withColumn(quota, F.coalesce(whole, F.lit(0)).cast("bigint"))
        .withColumn("remainder", F.expr(f"{product} % CAST(all_rows AS DECIMAL(19, 0))"))
        .withColumn("open", F.lit(total) - F.sum(quota).over(everything))
        .withColumn("place", F.row_number().over(everything.orderBy(rest.desc(), "class")))
        .withColumn(quota, F.col(quota) + (F.col("place") <= F.col("open")).cast("bigint"))
        .drop("all_rows", "remainder", "open", "place")
    )


def split_by_class(
    df: DataFrame,
    n_validation: int,
    n_test: int,
    class_column: str,
    key: str,
    seed: int = SPLIT_SEED,
    strict: bool = False,
    rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Add ``split``: exact totals for test and validation, every class in proportion.

    ``key`` must be unique. Within a class, rows are ordered by their digest; the first go to
    test, the next to validation, the rest to train. The two cut points of a class are found
    by counting rows per (class, digest prefix) and then looking only into the prefix where a
    cut falls; a prefix with more than ``rows_per_cut`` rows is counted again by longer ones. So no class is sorted as a whole, and the frame itself is not shuffled: each
    row is compared with the cuts of its class. Equal keys at a cut raise. Classes are counted before their cuts are
    sent to all rows.
    """
    drawn = df.select(
        F.col(class_column).alias("class"), row_digest([key], seed).alias("digest")
    ).withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))
    buckets = materialize(drawn.groupBy("class", "bucket").agg(F.count("*").alias("n")))
    sizes = buckets.groupBy("class").agg(F.sum("n").alias("size"))
    classes = check_split(sizes, n_validation, n_test, strict)
    few = F.broadcast if 2 * classes <= BROADCAST_ROWS else (lambda df: df)

    quotas = _shares(sizes, "size", n_test, "test_quota")
    left = quotas.withColumn("left", F.col("size") - F.col("test_quota"))
    quotas = _shares(left, "left", n_validation, "validation_quota")
    ends = quotas.select(
        F.col("class").alias("cut_class"),
        F.explode(
            F.create_map(
                F.lit("test"), F.col("test_quota"),
                F.lit("validation"), F.col("test_quota") + F.col("validation_quota"),
            )
        ).alias("cut", "end"),
    )
    running = Window.partitionBy("class").orderBy("bucket")
    upto = buckets.withColumn("upto", F.sum("n").over(running))
    cuts = upto.join(
        ends,
        F.col("class").eqNullSafe(F.col("cut_class"))
        & (F.col("end") <= F.col("upto"))
        & (F.col("end") > F.col("upto") - F.col("n")),
    ).select(
        "cut_class", F.col("bucket").alias("cut_bucket"), "cut",
        (F.col("end") - F.col("upto") + F.col("n")).alias("nth"), "n",
    )
    in_bucket = Window.partitionBy("cut_class", "cut").orderBy("digest")
    alike = Window.partitionBy("cut_class", "cut", "digest")
    nearby, cuts = _near_cuts(drawn, cuts, few, rows_per_cut)
    at_cut = materialize(
        nearby.withColumn("place", F.row_number().over(in_bucket))
        .withColumn("alike", F.count("*").over(alike))
        .where(F.col("place") == F.col("nth"))
    )
    if at_cut.where("alike > 1").limit(1).count():
        raise ValueError(f"{key} is not unique, so the totals can't be exact")
    limits = (
        at_cut.groupBy("cut_class")
        .agg(*[
            F.max(F.when(F.col("cut") == name, F.col("digest"))).alias(f"{name}_end")
            for name in ("test", "validation")
        ])
    )
    digest = row_digest([F.col(key)], seed)
    return (
        df.join(few(limits), F.col(class_column).eqNullSafe(F.col("cut_class")), "left")
        .withColumn(
            "split",
            F.when(digest <= F.col("test_end"), "test")
            .when(digest <= F.col("validation_end"), "validation")
            .otherwise("train"),
        )
        .drop("cut_class", "test_end", "validation_end")
    )


def _near_cuts(
    drawn: DataFrame, cuts: DataFrame, few: Callable[[DataFrame], DataFrame], most: int
) -> tuple[DataFrame, DataFrame]:
    """Rows whose digest begins like a cut, with prefixes long enough that they are few per cut."""
    digits = BUCKET_DIGITS
    while True:
        cuts = materialize(cuts)
        nearby = drawn.join(
            few(cuts),
            F.col("class").eqNullSafe(F.col("cut_class"))
            & (F.substring("digest", 1, digits) == F.col("cut_bucket")),
        )
        largest = cuts.agg(F.max("n")).first()[0] or 0
        if largest <= most or digits >= DIGEST_DIGITS:
            return nearby, cuts
        digits += BUCKET_DIGITS
        finer = F.substring("digest", 1, digits).alias("cut_bucket")
        counted = nearby.groupBy("cut_class", "cut", "nth", finer).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("cut_class", "cut").orderBy("cut_bucket"))
        inside = (F.col("nth") <= F.col("upto")) & (F.col("nth") > F.col("upto") - F.col("n"))
        cuts = counted.withColumn("upto", upto).where(inside).select(
            "cut_class", "cut_bucket", "cut",
            (F.col("nth") - F.col("upto") + F.col("n")).alias("nth"), "n",
        )


def check_split(sizes: DataFrame, n_validation: int, n_test: int, strict: bool) -> int:
    """Refuse totals the frame cannot give; ``strict`` also refuses classes too small to divide.

    Returns the number of classes, which bounds the tables of cuts.
    """
    rows, classes, smallest = sizes.agg(F.sum("size"), F.count("*"), F.min("size")).first()
    if classes > MAX_CLASSES:
        raise ValueError(f"{classes} classes; {MAX_CLASSES} are supported")
    if n_validation + n_test > (rows or 0):
        raise ValueError(
            f"{n_test} test and {n_validation} validation rows wanted, {rows or 0} present"
        )
    if strict and (smallest < 2 or min(n_validation, n_test) < classes):
        raise ValueError(
            f"{classes} classes, the smallest of {smallest} rows, cannot be divided "
            f"into {n_test} test and {n_validation} validation rows"
        )
    return classes
