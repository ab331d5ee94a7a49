"""Join helpers that hold up when one key has a large share of all rows.

Two shapes cover every join of the product:

* ``lookup``: a reference frame that should be small. It is broadcast only after its rows were
  counted (``Lookup.checked``); a larger one is joined by a salted shuffle.
* ``join_unique``: a large frame against another large frame that is unique on the key. Keys
  that hold a large share of the left side are answered by a broadcast of their (few) right
  rows, all other keys by an ordinary shuffle join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# A lookup above this many rows or bytes is not broadcast.
LOOKUP_ROW_LIMIT = 1_000_000
LOOKUP_BYTE_LIMIT = 64 << 20
# A key is hot when it has this many times the rows that a reducer gets on average.
HOT_FACTOR = 2
# Rows, unique on their key, that a task may hold to join others to them without sorting either side.
HASHED_ROWS = 1_000_000
# Least number of cells that keys are counted in; it grows with the number of keys that can be hot.
_CELLS = 16_384
_CELLS_PER_HOT_KEY = 64
_LOOKUP_SALTS = 32


# ---------------------------------------------------------------- hot keys


def hot_keys(
    df: DataFrame,
    *columns: str,
    share: float | None = None,
    min_rows: int = 0,
) -> dict[str, list[Any]]:
    """Values of each column that hold a large share of all rows (NULL included as ``None``).

    ``share`` is by default ``HOT_FACTOR`` times what one of the session's shuffle partitions
    gets. One pass counts the rows of every column by cells of its hashed keys: a hot key makes its
    cell hot. Only the rows of hot cells, mostly none, are then counted by key, so nothing is shuffled
    by key. The result has at most ``1 / share`` values per column and only steers the physical path:
    every list, even an empty one, gives the same rows.
    """
    if share is None:
        reducers = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = min(1.0, HOT_FACTOR / reducers)
    top = int(1 / share) + 1
    cells = max(_CELLS, _CELLS_PER_HOT_KEY * top)
    cell = {c: F.pmod(F.xxhash64(c), F.lit(cells)) for c in columns}
    # Cells of all columns side by side; the row itself is counted as cell -1.
    of_row = [F.lit(-1).cast("bigint"), *[cell[c] + n * cells for n, c in enumerate(columns)]]
    counts = df.select(F.explode(F.array(*of_row)).alias("_cell")).groupBy("_cell").agg(
        F.count(F.lit(1)).alias("_n")
    )
    # No more cells than these can reach the share.
    largest = counts.orderBy(F.desc("_n"), "_cell").limit(1 + top * len(columns)).collect()
    rows = next((r["_n"] for r in largest if r["_cell"] == -1), 0)
    floor = max(min_rows, rows * share)
    found: dict[str, list[Any]] = {}
    for n, c in enumerate(columns):
        mine = [r["_cell"] - n * cells for r in largest if r["_cell"] // cells == n and r["_n"] >= floor]
        found[c] = _busy(df.filter(cell[c].isin(mine)), c, floor) if mine else []
    return found


def _busy(df: DataFrame, column: str, floor: float) -> list[Any]:
    """Values with at least ``floor`` rows, the most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= floor)
    return [r[column] for r in counts.orderBy(F.desc("_n"), column).collect()]


def is_one_of(column: Column, values: Sequence[Any]) -> Column:
    """Membership that treats NULL as a value; never NULL itself."""
    plain = [v for v in values if v is not None]
    hit = F.coalesce(column.isin(plain), F.lit(False)) if plain else F.lit(False)
    return hit | column.isNull() if None in values else hit


def busiest_keys(df: DataFrame, column: str, n: int) -> list[Any]:
    """The ``n`` most frequent values of a column, the smaller first among equally frequent ones."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return [r[column] for r in counts.orderBy(F.desc("_n"), column).limit(n).collect()]


# ---------------------------------------------------------------- large-to-large


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "left",
    hot: Sequence[Any] = (),
) -> DataFrame:
    """Join ``left`` to ``right``, which is unique on ``on``; ``how`` is left, inner or semi.
    Rows of hot keys take the values of a broadcast with at most one row per hot key and are
    spread over the reducers by the partition they come from (the same after a task retry),
    so neither a popular key nor many copies of one row end up in a single task.
    """
    if how not in ("left", "inner", "semi"):
        raise ValueError(f"unsupported join type {how!r}")
    if how == "semi":
        right = right.select(on)
    if not hot:
        return left.join(right, on, "left_semi" if how == "semi" else how)

    payload = [c for c in right.columns if c != on]
    few = F.broadcast(
        right.filter(is_one_of(F.col(on), [v for v in hot if v is not None])).select(
            F.col(on), *[F.col(c).alias(f"_hot_{c}") for c in payload], F.lit(True).alias("_hit")
        )
    )
    many = right.select(
        F.col(on), F.lit(0).alias("_salt"), *payload, F.lit(True).alias("_found")
    )
    is_hot = is_one_of(F.col(on), hot)
    spread = F.when(is_hot, F.spark_partition_id() + 1).otherwise(0)
    joined = (
        left.withColumn("_salt", spread).join(few, on, "left").join(many, [on, "_salt"], "left")
    )
    if how != "left":
        joined = joined.filter(F.coalesce("_hit", "_found", F.lit(False)))
    return joined.select(
        *left.columns,
        *[F.coalesce(F.col(f"_hot_{c}"), F.col(c)).alias(c) for c in payload],
    )


@dataclass(frozen=True)
class Stored:
    """A table stored in buckets of ``key``, rows of hot keys apart.

    ``cold`` is read bucket by bucket, so joins and groupings on the key need no shuffle; ``hot``
    holds the rows of the ``keys`` that are too many for one task and is read in ordinary splits.
    ``hashed`` says that a bucket of unique keys is small enough for a task to hold (``HASHED_ROWS``).
    """

    cold: DataFrame
    hot: DataFrame
    key: str
    keys: tuple[Any, ...] = ()
    hashed: bool = False

    @staticmethod
    def split(
        table: DataFrame, flag: str, key: str, keys: Sequence[Any], hashed: bool = False
    ) -> Stored:
        """``flag`` is the partition column that keeps hot rows in files of their own."""
        cold, hot = table.filter(~F.col(flag)).drop(flag), table.filter(F.col(flag)).drop(flag)
        return Stored(cold, hot, key, tuple(keys), hashed)

    def opposite(self, right: DataFrame) -> DataFrame:
        """The frame, unique on the key, that cold rows meet: held by each task if it may be, else sorted."""
        return right.hint("shuffle_hash") if self.hashed else right

    @property
    def all_rows(self) -> DataFrame:
        return self.cold.unionByName(self.hot) if self.keys else self.cold


def join_stored(left: Stored, right: DataFrame) -> DataFrame:
    """Left join to a frame that is unique on the key and stored in the same buckets.

    Cold rows meet bucket by bucket. Hot rows take a broadcast of the right rows of the hot keys, at
    most one for each; nothing moves by key.
    """
    cold = left.cold.join(left.opposite(right), left.key, "left")
    if not left.keys:
        return cold
    few = right.filter(is_one_of(F.col(left.key), [v for v in left.keys if v is not None]))
    return cold.unionByName(left.hot.join(F.broadcast(few), left.key, "left"))


# ---------------------------------------------------------------- lookups


def _width(frame: DataFrame, column: str) -> Column:
    """Bytes of a value in a broadcast: eight for the slot, and the text itself."""
    if isinstance(frame.schema[column].dataType, StringType):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint") + 8
    return F.lit(8).cast("bigint")


@dataclass(frozen=True)
class Lookup:
    """A reference frame and whether its counted size allows a broadcast."""

    frame: DataFrame
    fits: bool

    @staticmethod
    def checked(
        frames: dict[str, DataFrame], row_limit: int = LOOKUP_ROW_LIMIT
    ) -> dict[str, Lookup]:
        """Count all frames in one job and allow a broadcast of those within the limit."""
        sizes = Lookup.sizes(frames, row_limit)
        return {name: Lookup(df, sizes[name] <= row_limit) for name, df in frames.items()}

    @staticmethod
    def sizes(
        frames: dict[str, DataFrame], row_limit: int = LOOKUP_ROW_LIMIT
    ) -> dict[str, int]:
        """Row counts; each count stops just above the limit.

        A frame whose values take more than ``LOOKUP_BYTE_LIMIT`` counts as above the limit.
        """
        counts = None
        for name, frame in frames.items():
            width = reduce(add, [_width(frame, c) for c in frame.columns])
            one = (
                frame.select(width.alias("x"))
                .limit(row_limit + 1)
                .agg(F.count("x").alias("n"), F.coalesce(F.sum("x"), F.lit(0)).alias("bytes"))
                .select(F.lit(name).alias("name"), "n", "bytes")
            )
            counts = one if counts is None else counts.unionByName(one)
        found = [] if counts is None else counts.collect()
        return {
            r["name"]: r["n"] if r["bytes"] <= LOOKUP_BYTE_LIMIT else row_limit + 1 for r in found
        }

    def map(self, frame: DataFrame) -> Lookup:
        """The same lookup after a projection or filter, which cannot make it larger."""
        return Lookup(frame, self.fits)


def lookup(
    left: DataFrame, ref: Lookup, on: str | Iterable[str], how: str = "left"
) -> DataFrame:
    """Join to a reference frame: broadcast if it fits, else a salted shuffle join."""
    keys = [on] if isinstance(on, str) else list(on)
    if ref.fits:
        return left.join(F.broadcast(ref.frame), keys, how)
    salted = left.withColumn("_salt", F.spark_partition_id() % _LOOKUP_SALTS)
    copies = F.explode(F.sequence(F.lit(0), F.lit(_LOOKUP_SALTS - 1)))
    right = ref.frame.withColumn("_salt", copies)
    return salted.join(right, [*keys, "_salt"], how).drop("_salt")
