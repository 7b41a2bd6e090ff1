"""Running computations over ordered keys of any size.

A window over ``partitionBy(user)`` puts all rows of a user into one task. That is the best plan for
ordinary keys and a dead end for a key that holds a large share of the table. ``by_key`` therefore counts the
rows per key first and treats the two kinds apart:

* ordinary keys (at most ``rows_per_block`` rows) run plain windows, one hash shuffle for all of them, over as many tasks
  as give each about ``rows_per_block`` rows;
* oversized keys are range-partitioned on ``key + order`` into blocks of about ``rows_per_block`` consecutive
  rows. Every running value is then the value inside the block combined with an opening value, which comes from
  the block totals: a table with one row per block and group, so no task ever sees more than a block of rows.

A task's sorts hold all its rows, several times over for several windows, so both numbers follow from the rows counted and not
from bytes: the planner would join small partitions into larger ones as the table grows.

The block number is the range partition a row fell into. Range bounds come from a sample, so the numbered rows are
written once and read back; a recomputed task can then never see other bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import materialise, rows_per_block

BLOCK = "_block"
BROADCAST_KEYS = 200_000


@dataclass(frozen=True)
class Running:
    """A running value over the rows before the current one, within ``by``.

    ``op`` is ``sum`` (0 when nothing came before), ``max`` or ``last`` (last non-null value, else null).
    """

    name: str
    op: str
    value: Column
    by: tuple[str, ...] = ()


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match each other; keeps the left key columns only."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on])
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


@dataclass(frozen=True)
class Series:
    """Rows of many keys, each key ordered by ``order``; ``cut`` means the keys are cut into ``blocks`` blocks, numbered from 0.

    ``rows`` is how many there are at most, as far as known.
    """

    df: DataFrame
    key: tuple[str, ...]
    order: tuple[str, ...]
    cut: bool = False
    blocks: int = 1
    rows: int = 0

    def _groups(self, by: Sequence[str] = ()) -> list[str]:
        return [*self.key, *([BLOCK] if self.cut else []), *by]

    def _window(self, by: Sequence[str] = ()):
        return Window.partitionBy(*self._groups(by)).orderBy(*self.order)

    def _with(self, df: DataFrame) -> Series:
        return replace(self, df=df)

    def with_columns(self, columns: dict[str, Column]) -> Series:
        return self._with(self.df.withColumns(columns))

    def transform(self, fn: Callable[[DataFrame], DataFrame]) -> Series:
        return self._with(fn(self.df))

    def colocate(self, *columns: str) -> Series:
        """One hash shuffle that all later windows of this series can share. Blocks are placed where they are read."""
        if self.cut:
            return self
        tasks = -(-self.rows // rows_per_block(self.df.sparkSession))
        enough = tasks <= self.df.sparkSession.sparkContext.defaultParallelism
        return self._with(self.df.repartition(*([] if enough else [tasks]), *(columns or self.key)))

    def _placed(self) -> DataFrame:
        """The rows with every block in a task of its own."""
        return self.df.repartitionById(self.blocks, F.col(BLOCK)) if self.cut else self.df

    def rekey(self, key: Sequence[str], order: Sequence[str] | None = None) -> Series:
        """The same rows under another key. Oversized keys are cut anew."""
        key, order = tuple(key), tuple(order or self.order)
        if not self.cut:
            return replace(self, key=key, order=order)
        return cut_into_blocks(self.df.drop(BLOCK), key, order, self.blocks)

    def lag(self, columns: Sequence[str], depth: int) -> Series:
        """Adds ``<column>_<i>`` for i = 1..depth: the value i rows earlier in the key."""

        def lags(window) -> dict[str, Column]:
            return {f"{c}_{i}": F.lag(c, i).over(window) for c in columns for i in range(1, depth + 1)}

        if not self.cut:
            return self._with(self.df.withColumns(lags(self._window())))
        inside = self._window()
        marked = self._placed().withColumns(
            {
                **lags(inside),
                "_rank": F.row_number().over(inside),
                "_later": F.lead(F.lit(1), depth).over(inside),
            }
        )
        # The first rows of a block look back into earlier blocks. The rows at both ends of all blocks of a key,
        # in order, hold every row they can reach: a table of at most 2 x depth rows per block.
        ends = marked.where((F.col("_rank") <= depth) | F.col("_later").isNull())
        across = Window.partitionBy(*self.key).orderBy(*self.order)
        heads = ends.withColumns(lags(across)).where(F.col("_rank") <= depth)
        body = marked.where(F.col("_rank") > depth)
        return self._with(body.unionByName(heads).drop("_rank", "_later"))

    def running(self, *specs: Running, keep: bool = True) -> Series:
        """Adds one running value per spec.

        With blocks, the rows are read once for the values and once per spec for the block totals, so steps that
        build on each other write their result down in between; ``keep=False`` leaves that out at the end of a chain.
        """
        inside = {s.name: _inside(s, self._window(s.by)) for s in specs}
        result = self._placed().withColumns(inside)
        if not self.cut:
            return self._with(result)
        for spec in specs:
            result = self._open(result, spec)
        return self._with(materialise(result) if keep else result)

    def _open(self, result: DataFrame, spec: Running) -> DataFrame:
        groups = [*self.key, *spec.by]
        earlier = Window.partitionBy(*groups).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        totals = self.df.groupBy(*groups, BLOCK).agg(_block_total(spec, self.order).alias("_total"))
        opening = totals.select(*groups, BLOCK, _over_blocks(spec, earlier).alias("_opening")).where(
            F.col("_opening").isNotNull()
        )
        # Written down first, so that the planner knows its size: small tables are broadcast and leave the rows where
        # they are, large ones (one row per value and block) are joined by shuffle.
        joined = join_null_safe(result, materialise(opening), [*groups, BLOCK], "left")
        return joined.withColumn(spec.name, _combine(spec, F.col(spec.name), F.col("_opening"))).drop("_opening")


def _inside(spec: Running, window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    if spec.op == "sum":
        return F.coalesce(F.sum(spec.value).over(before), F.lit(0))
    if spec.op == "max":
        return F.max(spec.value).over(before)
    if spec.op == "last":
        return F.last(spec.value, ignorenulls=True).over(before)
    raise ValueError(f"unknown running operation: {spec.op}")


def _block_total(spec: Running, order: Sequence[str]) -> Column:
    if spec.op == "sum":
        return F.sum(spec.value)
    if spec.op == "max":
        return F.max(spec.value)
    return F.max(F.when(spec.value.isNotNull(), F.struct(*order, spec.value.alias("_value"))))


def _over_blocks(spec: Running, earlier) -> Column:
    if spec.op == "sum":
        return F.sum("_total").over(earlier)
    if spec.op == "max":
        return F.max("_total").over(earlier)
    return F.max("_total").over(earlier)["_value"]


def _combine(spec: Running, inside: Column, opening: Column) -> Column:
    if spec.op == "sum":
        return inside + F.coalesce(opening, F.lit(0))
    if spec.op == "max":
        return F.greatest(inside, opening)
    return F.coalesce(inside, opening)


def cut_into_blocks(df: DataFrame, key: Sequence[str], order: Sequence[str], blocks: int) -> Series:
    laid = df.repartitionByRange(blocks, *key, *order).withColumn(BLOCK, F.spark_partition_id())
    return Series(materialise(laid), tuple(key), tuple(order), cut=True, blocks=blocks)


class ByKey:
    """Ordinary and oversized keys of a table, kept apart.

    ``apply`` runs the same steps on both; ``frame`` gives all rows back; ``rows`` is how many there are.
    """

    def __init__(self, parts: list[Series], oversized: DataFrame | None, few: bool, rows: int):
        self.parts = parts
        self._oversized = oversized
        self._few = few
        self.rows = rows

    @property
    def split(self) -> bool:
        """Whether there are oversized keys."""
        return self._oversized is not None

    def apply(self, *steps: Callable[[Series], Series]) -> ByKey:
        parts = self.parts
        for step in steps:
            parts = [step(p) for p in parts]
        return ByKey(parts, self._oversized, self._few, self.rows)

    def frame(self) -> DataFrame:
        frames = [p.df.drop(BLOCK) for p in self.parts]
        return reduce(lambda a, b: a.unionByName(b), frames)

    def again(self, df: DataFrame, key: Sequence[str], order: Sequence[str]) -> ByKey:
        """Keep other rows of the same keys apart in the same way, without counting again.

        ``key`` must extend the key that was counted.
        """
        if self._oversized is None:
            return ByKey([Series(df, tuple(key), tuple(order), rows=self.rows)], None, True, self.rows)
        counted = self._oversized.columns
        keys = F.broadcast(self._oversized) if self._few else self._oversized
        cold = join_null_safe(df, keys, counted, "left_anti")
        hot = join_null_safe(df, keys, counted, "left_semi")
        blocks = self.parts[-1].blocks
        return ByKey(
            [Series(cold, tuple(key), tuple(order), rows=self.rows), cut_into_blocks(hot, key, order, blocks)],
            self._oversized,
            self._few,
            self.rows,
        )


def by_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ("sec", "seq"), limit: int | None = None) -> ByKey:
    """Count the rows per key and keep keys with more than ``limit`` rows apart.

    The count is one map-side-combined aggregation. At most ``rows / limit`` keys can be oversized, which is what
    bounds their table; beyond ``BROADCAST_KEYS`` of them it is joined by shuffle.
    """
    limit = rows_per_block(df.sparkSession, limit)
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    over = F.col("_rows") > limit
    found = sizes.agg(
        F.count_if(over).alias("keys"),
        F.sum(F.when(over, F.col("_rows"))).alias("rows"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("all"),
    ).first()
    if not found["keys"]:
        return ByKey([Series(df, tuple(key), tuple(order), rows=found["all"])], None, True, found["all"])
    blocks = -(-found["rows"] // limit) + 1
    few = found["keys"] <= BROADCAST_KEYS
    oversized = materialise(sizes.where(over).select(*key))
    keys = F.broadcast(oversized) if few else oversized
    cold = join_null_safe(df, keys, list(key), "left_anti")
    hot = join_null_safe(df, keys, list(key), "left_semi")
    return ByKey(
        [Series(cold, tuple(key), tuple(order), rows=found["all"] - found["rows"]), cut_into_blocks(hot, key, order, blocks)],
        oversized,
        few,
        found["all"],
    )


def in_one_order(
    df: DataFrame, order: Sequence[str] = ("sec", "seq"), limit: int | None = None, rows: int | None = None
) -> Series:
    """All rows as one series, cut into blocks as soon as they exceed one block. ``rows`` saves the count."""
    limit = rows_per_block(df.sparkSession, limit)
    rows = df.count() if rows is None else rows
    if rows <= limit:
        return Series(df, (), tuple(order))
    return cut_into_blocks(df, (), order, -(-rows // limit))
