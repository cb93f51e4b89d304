"""Ordered per-key computation that survives a key holding most of the rows.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.  A
:class:`Track` first counts rows per key (map-side combined, one narrow
column).  If no key is large, the window is used as it is: one exchange, one
sort.  A large key is cut along its own order into slices of about equal row
count; windows then run per (key, slice), and what a slice needs from the ones
before it (their last row, their sums) comes from one summary row per slice,
which is joined back by broadcast.  The number of slices is bounded by
``Sizing.max_slices``, so that broadcast is bounded too.

The slice of a row is a function of the row's own values and the chosen cuts.
Every evaluation of a plan, task retries included, therefore agrees on it, and
cuts taken from one table stay valid for any other: only the balance depends on
them, never the result.  Rows are sampled to choose cuts and for nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wayfleet.config import ROW_ORDER, SIZING, Sizing
from wayfleet.session import shared_folder

SLICE = "_slice"
_SAMPLES_PER_SLICE = 64
#: Cut points up to this number pass through the driver; more stay in Spark.
_FEW_CUTS = 2_000
#: A row is compared with the cuts of a page, which travels with it, on each level.
_PAGE = 64


@dataclass(frozen=True)
class Track:
    """Rows grouped by ``keys`` and ordered by ``order`` within each key.

    ``cuts`` is None when nothing needs slicing; otherwise it has one row per
    sliced key with the ascending cut points of that key.  ``longest`` is the
    number of cut points in the longest of them.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: DataFrame | None = None
    longest: int = 0

    # -- planning ---------------------------------------------------------

    @classmethod
    def of(
        cls,
        rows: DataFrame,
        keys: Sequence[str] = ("taxi_id",),
        order: Sequence[str] = ROW_ORDER,
        sizing: Sizing = SIZING,
    ) -> "Track":
        """Measure ``rows`` and choose cuts for the keys that need them.

        With no keys the whole table is one ordered sequence; it is cut into at
        least as many slices as the session has cores.
        """
        keys, order = tuple(keys), tuple(order)
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        total, largest = counts.agg(F.sum("n"), F.max("n")).first()
        if not total:
            return cls(keys, order)
        limit = max(sizing.slice_rows, -(-total // sizing.max_slices))
        if not keys:
            cores = rows.sparkSession.sparkContext.defaultParallelism
            limit = max(1, min(limit, -(-total // cores)))
        if largest <= limit:
            return cls(keys, order)

        # At most ``max_slices`` keys can have more than ``limit`` rows.
        large = counts.filter(F.col("n") > limit).drop("n")
        candidates = rows.join(F.broadcast(large), list(keys), "left_semi") if keys else rows
        fields = [f"_o{i}" for i in range(len(order))]
        placed = candidates.select(*keys, *_order_fields(rows, order))

        def cut_points(placed: DataFrame, stride: int) -> DataFrame:
            """Every ``limit``-th row of a key, counted in a sample of one row in
            ``stride``; about 2 * max_slices points at most."""
            picked = placed.filter(F.pmod(F.xxhash64(*fields), F.lit(stride)) == 0)
            ranked = picked.withColumn("_rank", F.row_number().over(_window(keys, fields)))
            points = ranked.filter(F.col("_rank") % (limit // stride) == 0)
            found = points.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_cuts"))
            return _kept(found.filter(F.size("_cuts") > 0), total // limit)

        stride = max(1, limit // _SAMPLES_PER_SLICE)
        cuts = cut_points(placed, stride)
        # A sample may have picked no row of a key; such keys are counted whole.
        if stride > 1:
            if keys:
                missed = large.join(cuts, list(keys), "left_anti")
                if not missed.isEmpty():
                    rest = placed.join(F.broadcast(missed), list(keys), "left_semi")
                    cuts = cuts.unionByName(cut_points(rest, 1))
            elif cuts.isEmpty():
                cuts = cut_points(placed, 1)
        longest = cuts.agg(F.max(F.size("_cuts"))).first()[0]
        if longest is None:  # only rows without a key are that many
            return cls(keys, order)
        return cls(keys, order, cuts, longest)

    @property
    def slices(self) -> tuple[tuple[tuple, int], ...]:
        """Sliced keys and their numbers of slices, brought to the driver."""
        if not self.sliced:
            return ()
        sizes = self.cuts.select(*self.keys, (F.size("_cuts") + 1).alias("_n")).collect()
        return tuple((tuple(r[k] for k in self.keys), r["_n"]) for r in sizes)

    def cells(self) -> DataFrame:
        """A row for each slice of each sliced key."""
        numbers = F.sequence(F.lit(0), F.size("_cuts"))
        return self.cuts.select(*self.keys, F.explode(numbers).alias(SLICE))

    @property
    def sliced(self) -> bool:
        return self.cuts is not None

    @property
    def group(self) -> tuple[str, ...]:
        """Columns that identify one window partition."""
        return self.keys + ((SLICE,) if self.sliced else ())

    def window(self):
        return _window(self.group, self.order)

    def mark(self, rows: DataFrame) -> DataFrame:
        """Add the slice number: NULL for keys that are not sliced.

        The number is found by pages: among every 64th, every 64 * 64th, ... of a
        key's cuts first, then among the cuts between two of those.  A row carries
        one page at a time, however many cuts its key has."""
        if not self.sliced or SLICE in rows.columns:
            return rows
        top = 0
        while _PAGE ** (top + 1) <= self.longest:
            top += 1
        first = self._thinned(top)
        # Of the cuts' own type, so that no comparison converts it.
        point = F.struct(*_order_fields(rows, self.order)).cast(first.schema["_cuts"].dataType.elementType)
        marked = rows.withColumn("_point", point)
        if self.keys:
            marked = marked.join(F.broadcast(first), list(self.keys), "left")
        else:
            marked = marked.withColumn("_cuts", first.scalar())
        marked = _searched(marked, self.longest // _PAGE**top)
        marked = marked.withColumn(SLICE, F.when(F.col("_cuts").isNotNull(), F.col("_found"))).drop("_cuts")
        for level in reversed(range(top)):
            pages = F.broadcast(self._pages(level))
            marked = _searched(marked.join(pages, [*self.keys, SLICE], "left"), _PAGE - 1)
            marked = marked.withColumn(SLICE, F.col(SLICE) * _PAGE + F.col("_found")).drop("_cuts")
        return marked.select(*rows.columns, SLICE)

    def _thinned(self, level: int) -> DataFrame:
        """Every ``_PAGE ** level``-th cut of each sliced key."""
        if not level:
            return self.cuts
        step = _PAGE**level
        places = F.filter(F.sequence(F.lit(0), F.floor(F.size("_cuts") / step).cast("int")), lambda i: i > 0)
        return self.cuts.select(*self.keys, F.transform(places, lambda i: F.get("_cuts", i * step - 1)).alias("_cuts"))

    def _pages(self, level: int) -> DataFrame:
        """The cuts of a level between two of the level above, numbered by how many
        of those come before them."""
        numbers = F.sequence(F.lit(0), F.floor(F.size("_cuts") / _PAGE).cast("int"))
        places = F.sequence(F.lit(0), F.lit(_PAGE - 2))

        def page(nth: Column) -> Column:
            cuts = F.transform(places, lambda i: F.get("_cuts", nth * _PAGE + i))
            return F.struct(nth.alias(SLICE), F.filter(cuts, F.isnotnull).alias("_cuts"))

        pages = self._thinned(level).select(*self.keys, F.transform(numbers, page).alias("_pages"))
        return pages.select(*self.keys, F.inline("_pages"))

    def unmark(self, rows: DataFrame) -> DataFrame:
        return rows.drop(SLICE)

    def _sliced_rows(self, rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(SLICE).isNotNull()) if self.keys else rows

    # -- ordered operators ------------------------------------------------

    def previous(self, rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        """Values of the row before, as ``{new name: source column}``; NULL on
        the first row of a key."""
        rows = self.mark(rows)
        here = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
        rows = rows.withColumn("_before", F.lag(here).over(self.window()))
        if self.sliced:
            order = F.struct(*[F.col(c) for c in self.order])
            last = (
                self._sliced_rows(rows)
                .groupBy(*self.group)
                .agg(F.max_by(here, order).alias("_last"))
            )
            entry = last.select(
                *self.group,
                F.lag("_last").over(_window(self.keys, (SLICE,))).alias("_entry"),
            )
            rows = rows.join(F.broadcast(entry), list(self.group), "left")
            rows = rows.withColumn("_before", F.coalesce("_before", "_entry"))
        return rows.select(
            *[c for c in rows.columns if c not in ("_before", "_entry")],
            *[F.col(f"_before.{n}").alias(n) for n in columns],
        )

    def running_sums(self, rows: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
        """Sums over all rows of the key up to and including each row, as
        ``{new name: expression}``.  NULL until the first non-NULL value."""
        rows = self.mark(rows)
        upto = self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = rows.select(
            "*", *[F.sum(e).over(upto).alias(n) for n, e in sums.items()]
        )
        if not self.sliced:
            return out
        totals = (
            self._sliced_rows(rows)
            .groupBy(*self.group)
            .agg(*[F.sum(e).alias(n) for n, e in sums.items()])
        )
        before = _window(self.keys, (SLICE,)).rowsBetween(Window.unboundedPreceding, -1)
        entry = totals.select(
            *self.group, *[F.sum(n).over(before).alias(f"_in_{n}") for n in sums]
        )
        out = out.join(F.broadcast(entry), list(self.group), "left")
        return out.select(
            *rows.columns,
            *[
                F.when(F.col(n).isNull(), F.col(f"_in_{n}"))
                .otherwise(F.col(n) + F.coalesce(f"_in_{n}", F.lit(0)))
                .alias(n)
                for n in sums
            ],
        )


def _kept(cuts: DataFrame, about: int) -> DataFrame:
    """The same rows, settled: a few in the driver, many in a shared folder."""
    spark = cuts.sparkSession
    if about <= _FEW_CUTS:
        return spark.createDataFrame(cuts.collect(), cuts.schema)
    path = f"{shared_folder(spark)}/cuts-{uuid.uuid4().hex}"
    cuts.write.parquet(path)
    return spark.read.schema(cuts.schema).parquet(path)


def _searched(rows: DataFrame, most: int) -> DataFrame:
    """Add how many of ``_cuts``, at most ``most``, are not after ``_point``
    (``_found``).  A column for each step of the binary search: the functions that
    take a lambda are not compiled."""
    found = F.lit(0)
    for step in reversed([1 << b for b in range(most.bit_length())]):
        # Past the end there is no cut, and nothing is not after the point.
        here = F.get("_cuts", found + (step - 1)) <= F.col("_point")
        rows = rows.withColumn("_found", found + F.when(here, step).otherwise(0))
        found = F.col("_found")
    return rows


def _window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def _order_fields(rows: DataFrame, order: Sequence[str]) -> list[Column]:
    """Order columns as plain numbers, so that cuts pass through the driver
    without any change of value."""
    fields = []
    for i, name in enumerate(order):
        column = F.col(name)
        if isinstance(rows.schema[name].dataType, T.TimestampType):
            column = F.unix_micros(column)
        fields.append(column.alias(f"_o{i}"))
    return fields
