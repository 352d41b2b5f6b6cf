"""Keep only rows that may find a partner, before anything is shuffled.

A bit set says which key digests occur on the small side. It is built by the cluster, sent to all
tasks, and looked up while the large table is scanned, so rows without a partner never travel. A row may
pass by chance; joins that follow decide. Where the large table is itself a join, name only key columns of its
largest part: the condition is then tested at the scan of that part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.session import materialize

WORD_BITS = 64
BLOCK_WORDS = 512  # words of a row of the bit set
BLOCK_BITS = WORD_BITS * BLOCK_WORDS
BITS_PER_KEY = 16  # about one row in sixteen without a partner passes
MAX_BITS = 1 << 29  # 64 MB are sent out at most; with more keys, more rows pass


def _digest(columns: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


class KeySet:
    """The digests of the keys of a frame as rows of bits: ``block`` and ``words``.

    Columns that have another type in the large table are not part of the digest, since equal values
    would differ there. Keys with nulls never match and are not in the set.
    """

    def __init__(self, keys: DataFrame, columns: list[str], large: DataFrame) -> None:
        types, own = dict(large.dtypes), dict(keys.dtypes)
        self.columns = [c for c in columns if types[c] == own[c]]
        self.table: DataFrame | None = None
        self.size = 0
        if not self.columns:
            return
        known = keys.select(*columns).dropna()
        self.size = known.count()
        blocks = -(-self.size * BITS_PER_KEY // BLOCK_BITS)
        self.bits = min(max(blocks, 1) * BLOCK_BITS, MAX_BITS)
        place = known.select(_digest(self.columns, self.bits).alias("place"))
        # Bits are set before the shuffle: a word is a partial aggregate, however many keys it has.
        words = place.groupBy(F.expr(f"place div {WORD_BITS}").alias("word")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast(place % {WORD_BITS} AS int))")).alias("bits")
        )
        numbered = F.struct(F.expr(f"cast(word % {BLOCK_WORDS} AS int)").alias("at"), "bits")
        rows = words.groupBy(F.expr(f"word div {BLOCK_WORDS}").alias("block")).agg(
            F.map_from_entries(F.collect_list(numbered)).alias("set")
        )
        dense = F.transform(
            F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1)),
            lambda i: F.coalesce(F.try_element_at("set", i), F.lit(0).cast("bigint")),
        )
        # Bounded: a row for each block, MAX_BITS altogether.
        self.table = materialize(rows.select("block", dense.alias("words")))


def _found(sets: tuple[KeySet, ...]) -> Column:
    """Whether any set has the digest of a row. A condition on the key columns alone, so Spark tests it as
    near to their scan as it can: below the joins that only add other columns."""
    found = F.lit(False)
    for s in sets:
        place = F.pmod(F.xxhash64(*[F.col(c).outer() for c in s.columns]), F.lit(s.bits))
        word = F.get("words", (place % BLOCK_BITS / WORD_BITS).cast("int"))
        bit = F.getbit(word, (place % WORD_BITS).cast("int"))
        block = F.floor(place / BLOCK_BITS).cast("bigint")
        hit = F.broadcast(s.table).where((F.col("block") == block) & (bit == 1))
        whole = F.lit(True)
        for c in s.columns:
            whole &= F.col(c).isNotNull()
        found |= whole & hit.exists()
    return found


def maybe_among(rows: DataFrame, *sets: KeySet) -> DataFrame:
    """The rows whose digest is in at least one of the sets. No shuffle; all columns stay."""
    if any(s.table is None for s in sets):
        return rows
    return rows.where(_found(sets))


def not_among(rows: DataFrame, keys: KeySet) -> DataFrame:
    """The rows whose key is certainly not in the set: all that ``maybe_among`` leaves out."""
    if keys.table is None:
        return rows.where("false")
    if not keys.size:
        return rows
    return rows.where(~_found((keys,)))
