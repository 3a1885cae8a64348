"""Ordered per-key columns (running totals, neighbours, rolling frames) that survive a hot key.

A Spark window puts every row of a key in one task. That is right for ordinary keys and
wrong for a key that holds a large share of the table. The functions here count the rows of
every key, keep the plain window for keys below an absolute number of rows, and give the rows
of the others a two-level plan instead:

* the rows are range-partitioned by key and order, whatever the key's distribution over time,
  and written with the number of their range;
* totals per (key, range) and a window over those few totals give each range its starting value;
* a window per (key, range) finishes the rows.

Frames that look at neighbouring rows run on blocks of consecutive row numbers that carry
copies of the few rows next to the block.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from carelattice.session import materialise

HOT_ROWS = 1_000_000
BLOCK_ROWS = 1_000_000


@dataclass(frozen=True)
class Running:
    """A value accumulated over the rows of a key up to the current one.

    ``kind`` is ``sum``, ``max`` or ``rows``. With ``inclusive=False`` the current row is left
    out. An empty sum is 0, an empty max is NULL.
    """

    kind: str
    column: Column | None = None
    inclusive: bool = True

    def over(self, window: WindowSpec) -> Column:
        framed = window.rowsBetween(Window.unboundedPreceding, 0 if self.inclusive else -1)
        if self.kind == "max":
            return F.max(self.column).over(framed)
        return F.coalesce(F.sum(self._addend()).over(framed), self._zero())

    def total(self) -> Column:
        return F.max(self.column) if self.kind == "max" else F.sum(self._addend())

    def merge(self, before: Column, here: Column) -> Column:
        if self.kind == "max":
            return F.greatest(before, here)
        return F.coalesce(before, self._zero()) + here

    def _addend(self) -> Column:
        return F.lit(1).cast("long") if self.kind == "rows" else self.column

    def _zero(self) -> Column:
        return F.lit(0)


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], weight: str | None = None) -> DataFrame | None:
    """The keys (as hashes, column ``hot_key``) that hold ``carelattice.hot.rows`` rows or more, or None. A row counts
    as often as the column ``weight`` says.

    An exact count per key, combined before its shuffle, on the key columns alone. The result is a
    written table that ``split`` joins; the driver only learns whether it is empty.
    """
    limit = int(df.sparkSession.conf.get("carelattice.hot.rows", str(HOT_ROWS)))
    counted = df.groupBy(key_hash(keys).alias("hot_key")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("rows"))
    found = materialise(counted.filter(F.col("rows") >= limit), "hot-keys")
    return None if found.isEmpty() else found.select("hot_key")


def split(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ordinary rows, hot rows)."""
    is_hot = key_hash(keys) == F.col("hot_key")
    return df.join(hot, is_hot, "left_anti"), df.join(hot, is_hot, "left_semi")


def ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], parts: int | None = None,
           name: str = "_slice") -> DataFrame:
    """Number the rows by ranges of (key, order) of about equal size: ``parts`` of them, or as many as
    adaptive execution finds right. The numbers are written with the rows, as ranges drawn again
    could differ."""
    columns = [F.col(k) for k in keys] + list(order)
    placed = df.repartitionByRange(parts, *columns) if parts else df.repartitionByRange(*columns)
    return materialise(placed.withColumn(name, F.spark_partition_id()), "ranges")


def sliced_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    running: Mapping[str, Running],
    group_rows: str | None = None,
) -> DataFrame:
    """Running values with each (key, range of rows) as its own unit of work.

    Used for hot keys, and with ``keys=[]`` for running values over a whole table without a
    one-task window. ``order`` must be total within a key. ``group_rows`` names a column that
    gets the row count of the whole key.
    """
    sliced = ranges(df, keys, order)
    totals = sliced.groupBy(*keys, "_slice").agg(
        *[r.total().alias(f"_t_{name}") for name, r in running.items()],
        F.count(F.lit(1)).alias("_t_rows"),
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col("_slice").alias("_o_slice"),
        *[
            (F.max if r.kind == "max" else F.sum)(f"_t_{name}").over(earlier).alias(f"_b_{name}")
            for name, r in running.items()
        ],
        F.sum("_t_rows").over(Window.partitionBy(*keys)).alias("_group_rows"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    same.append(F.col("_slice").eqNullSafe(F.col("_o_slice")))
    joined = sliced.join(offsets, reduce(lambda a, b: a & b, same))
    local = Window.partitionBy(*keys, "_slice").orderBy(*order)
    out = {name: r.merge(F.col(f"_b_{name}"), r.over(local)) for name, r in running.items()}
    if group_rows:
        out[group_rows] = F.col("_group_rows")
    return joined.withColumns(out).select(*df.columns, *out)


def _blocks(row: Column, before: int, after: int) -> Column:
    """The blocks a row number belongs to: its own, and those that need it as a neighbour."""
    block = F.floor((row - 1) / BLOCK_ROWS)
    place = F.pmod(row - 1, F.lit(BLOCK_ROWS))
    copies = [F.struct(block.alias("block"), F.lit(True).alias("own"))]
    if before:
        needed = place >= BLOCK_ROWS - before
        copies.append(F.when(needed, F.struct((block + 1).alias("block"), F.lit(False).alias("own"))))
    if after:
        needed = (place < after) & (block > 0)
        copies.append(F.when(needed, F.struct((block - 1).alias("block"), F.lit(False).alias("own"))))
    return F.filter(F.array(*copies), lambda c: c.isNotNull())


def ordered_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    running: Mapping[str, Running] | None = None,
    framed: Mapping[str, Callable[[WindowSpec], Column]] | None = None,
    before: int = 0,
    after: int = 0,
    group_rows: str | None = None,
    hot: DataFrame | bool | None = None,
) -> DataFrame:
    """Add running and neighbour columns per key.

    ``framed`` maps a new column to a function of an ordered window whose frame reaches at
    most ``before`` rows back and ``after`` rows ahead (lag, lead, short rolling sums).
    ``order`` must be total within a key. ``hot`` names the hot keys where they are known; False: no key is hot. None counts them.
    """
    running = dict(running or {})
    framed = dict(framed or {})
    hot = hot_keys(df, keys) if hot is None else hot

    def plain(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order)
        added = {name: r.over(window) for name, r in running.items()}
        added |= {name: build(window) for name, build in framed.items()}
        if group_rows:
            added[group_rows] = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        return rows.withColumns(added)

    if hot is None or hot is False:
        return plain(df)
    ordinary, heavy = split(df, keys, hot)
    numbered = sliced_running(
        heavy, keys, order, {**running, "_row": Running("rows")}, group_rows
    )
    if framed:
        spread = numbered.withColumn("_copy", F.explode(_blocks(F.col("_row"), before, after)))
        spread = spread.withColumn("_block", F.col("_copy.block"))
        window = Window.partitionBy(*keys, "_block").orderBy("_row")
        numbered = spread.withColumns({n: b(window) for n, b in framed.items()}).filter("_copy.own")
    done = plain(ordinary)
    return done.unionByName(numbered.select(*done.columns))


def ordinal(df: DataFrame, keys: Sequence[str], name: str, hot: DataFrame | None = None) -> DataFrame:
    """Number the rows that share a key 1..n, ordered by their other columns.

    Rows that are equal in every column are interchangeable, so a flood of equal rows is
    first counted (combined before the shuffle) and then expanded again in chunks.
    """
    rest = [c for c in df.columns if c not in keys]
    hot = hot_keys(df, keys) if hot is None else hot
    window = Window.partitionBy(*keys).orderBy(*rest)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, F.row_number().over(window).cast("long"))

    if hot is None:
        return plain(df)
    ordinary, heavy = split(df, keys, hot)
    first = Window.partitionBy(*keys).orderBy(*rest).rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        heavy.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(first), F.lit(0)))
    )
    chunk = 100_000
    chunks = counted.withColumn(
        "_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / chunk)))
    ).repartition(F.col("_start"), F.col("_c"))
    expanded = chunks.withColumn(
        "_i",
        F.explode(
            F.sequence(
                F.col("_c") * chunk + 1, F.least(F.col("_n"), (F.col("_c") + 1) * chunk)
            )
        ),
    ).withColumn(name, F.col("_start") + F.col("_i"))
    return plain(ordinary).unionByName(expanded.select(*df.columns, name))
