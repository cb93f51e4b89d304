"""Exact top-k inner products by best-first search of an M-tree.

Vectors are integers.  Each gets one more coordinate, sqrt(M - |x|^2) with M the
largest |x|^2, and a query gets 0 there: then |q - x|^2 = |q|^2 + M - 2 q.x, so the
nearest vectors in this metric are those of the largest inner products.

The tree has four levels.  Routing objects are vectors of the table: a sample,
bounded by ``PIVOTS``, supplies those of the pages and, out of these, those of
the groups above them.  A vector descends to the page of its nearest routing
object (oversized pages are cut by hash), and each page is cut into nodes of
about ``NODE`` vectors.  Every level stores covering radii and the distance of
each member to its parent's routing object.

A query is searched in its own page first, which gives a bound on its k-th best
distance, then in all pages that the bound does not exclude.  Inside a page
nodes are visited best first, nearest possible distance in front, until none
can hold a better vector.  Before any distance is computed, |d(q, parent) -
d(parent, object)| - radius, a lower bound by the triangle inequality made of
stored numbers, must not exceed the query's bound.  Bounds are floating-point
and have slack; scores are exact integers.

Equal vectors are one object with as many of their smallest ids as any result
needs (one more than k, as a query's own id is never in its result), so
thousands of copies are neither stored nor searched more than once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfleet.llm.vectors import integer_vectors, length, matrix
from wayfleet.llm.work import batches, forget, join_skewed, stored

FACTOR = 256
#: Vectors of a page and of a node, and the most routing objects of pages.
PAGE, NODE, PIVOTS = 4096, 64, 4096
#: Rows (query, page) of one pass: a fixed number and a multiple of the table's vectors.
PAIRS, PAIRS_PER_VECTOR = 100_000, 4
#: Rounding of a distance stays below this share of the longest vector.
_SLACK = 1e-6


class Space:
    """The metric: the components and the length that all vectors have in it."""

    def __init__(self, width: int, longest: float):
        self.width, self.longest = width, longest

    def points(self, v: list[bytes]) -> np.ndarray:
        own = matrix(v, self.width)
        rest = self.longest - np.einsum("ij,ij->i", own, own)
        return np.column_stack([own, np.sqrt(np.maximum(rest, 0))])

    def queries(self, v: list[bytes]) -> np.ndarray:
        return np.column_stack([matrix(v, self.width), np.zeros(len(v))])

    def reach(self, q: np.ndarray, floor: float) -> float:
        """Distance at which the inner product is ``floor``."""
        norm = q @ q
        slack = _SLACK * (1 + math.sqrt(max(norm, self.longest)))
        return math.sqrt(max(norm + self.longest - 2 * floor, 0)) + slack


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each row of ``a`` to each of ``b``."""
    squares = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b) - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


class Directory:
    """Routing objects of the pages below those of the groups, with distances
    between them; radii are there once the pages are filled."""

    def __init__(self, space: Space, pivots: list[bytes]):
        self.space = space
        self.pivots = space.points(pivots)
        self.tops = self.pivots[: max(1, math.isqrt(len(pivots)))]
        away = distances(self.pivots, self.tops)
        self.top_of, self.up = away.argmin(axis=1), away.min(axis=1)
        self.radius = np.zeros(len(pivots))

    def descend(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The page each point belongs to, and its distance to the routing object."""
        top = distances(points, self.tops).argmin(axis=1)
        page, away = np.zeros(len(points), dtype=np.int64), np.zeros(len(points))
        for t in np.unique(top):
            own, below = np.flatnonzero(top == t), np.flatnonzero(self.top_of == t)
            found = distances(points[own], self.pivots[below])
            page[own], away[own] = below[found.argmin(axis=1)], found.min(axis=1)
        return page, away

    def within(self, q: np.ndarray, reach: float) -> np.ndarray:
        """Pages that may hold something at ``reach`` or nearer."""
        above = distances(q[None], self.tops)[0]
        maybe = np.abs(above[self.top_of] - self.up) - self.radius <= reach
        near = np.flatnonzero(maybe)
        return near[distances(q[None], self.pivots[near])[0] - self.radius[near] <= reach]


class Page:
    """One page: entries sorted by node and distance to its routing object, the
    first entry of a node."""

    def __init__(self, space: Space, node: np.ndarray, away: np.ndarray, up: np.ndarray, v: list[bytes], ids: list):
        self.space, self.away, self.ids = space, away, ids
        self.points = space.points(v)
        start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        self.start = np.r_[start, len(node)]
        self.radius, self.up = away[self.start[1:] - 1], up[start]
        self.routing = self.points[start]

    def search(self, q: np.ndarray, to_page: float, floor: float, k: int) -> list[tuple[int, int]]:
        """(-score, id) of the k best entries that reach ``floor``, best first.

        ``to_page``: the query's distance to the page's routing object."""
        best: list[tuple[int, int]] = []
        reach = self.space.reach(q, floor) if math.isfinite(floor) else math.inf
        near = np.flatnonzero(np.abs(to_page - self.up) - self.radius <= reach)
        if not len(near):
            return best
        away = distances(q[None], self.routing[near])[0]
        lower = away - self.radius[near]
        for i in np.argsort(lower, kind="stable"):
            if lower[i] > reach:
                break
            a, b = self.start[near[i]], self.start[near[i] + 1]
            rows = a + np.flatnonzero(np.abs(away[i] - self.away[a:b]) <= reach)
            score = (self.points[rows] @ q).astype(np.int64)
            if len(score) > k:
                floor = max(floor, np.partition(score, -k)[-k])
            at = np.flatnonzero(score >= floor)
            best += [(-int(score[r]), x) for r in at for x in self.ids[rows[r]]]
            best = sorted(best)[:k]
            if len(best) == k:
                floor = max(floor, -best[-1][0])
            if math.isfinite(floor):
                reach = self.space.reach(q, floor)
        return best


def objects(rows: DataFrame, k: int) -> DataFrame:
    """v and ids, ascending: the k smallest ids of each vector.  The limit works
    before rows are shuffled, so a vector that many rows have meets no task."""
    own = Window.partitionBy("v").orderBy("vec_id")
    few = rows.distinct().withColumn("__n", F.row_number().over(own)).where(F.col("__n") <= k)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _routed(found: DataFrame, tree: Directory, space: Space, page: int) -> DataFrame:
    """pivot, cut, up (distance to the routing object), v, ids of every object."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            pivot, up = tree.descend(space.points(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pivot), pa.array(up), batch.column(0), batch.column(1)], names=["pivot", "up", "v", "ids"]
            )

    routed, _ = stored(
        found.select("v", "ids").mapInArrow(run, "pivot long, up double, v binary, ids array<long>"), "routed"
    )
    cuts = routed.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / (2 * page)).cast("long").alias("cuts"))
    return routed.join(F.broadcast(cuts), "pivot").withColumn("cut", F.pmod(F.xxhash64("v"), "cuts"))


def _paged(routed: DataFrame, space: Space, node: int) -> DataFrame:
    """The tree's entries: pivot, cut, node, away (distance to the node's routing
    object), up, v and ids.  A task holds one page."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (pivot, cut), table in _groups(source):
            v, up = table.column("v").to_pylist(), table.column("up").to_numpy()
            points = space.points(v)
            # Routing objects at even steps of the distance to the page's own.
            n = math.ceil(len(v) / node)
            chosen = np.argsort(up, kind="stable")[:: max(1, len(v) // n)]
            away = distances(points, points[chosen])
            away[chosen, np.arange(len(chosen))] = 0
            of, own = away.argmin(axis=1), away.min(axis=1)
            columns = [np.full(len(v), pivot), np.full(len(v), cut), of, own]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x) for x in columns), *(_one(table.column(c)) for c in ("up", "v", "ids"))],
                names=["pivot", "cut", "node", "away", "up", "v", "ids"],
            )

    dealt = routed.select("pivot", "cut", "up", "v", "ids").repartition("pivot", "cut").sortWithinPartitions("pivot", "cut", "v")
    kinds = "pivot long, cut long, node long, away double, up double, v binary, ids array<long>"
    return dealt.mapInArrow(run, kinds)


def _one(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _groups(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Table]]:
    """Rows of each (pivot, cut), the first two columns, of a sorted source."""
    at, held = None, []
    for batch in batches(source):
        pivot, cut = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        start = np.flatnonzero(np.r_[True, (pivot[1:] != pivot[:-1]) | (cut[1:] != cut[:-1])])
        for a, b in zip(start, np.r_[start[1:], len(pivot)], strict=True):
            key = (int(pivot[a]), int(cut[a]))
            if key != at and held:
                yield at, pa.Table.from_batches(held)
                held = []
            at = key
            held.append(batch.slice(a, b - a))
    if held:
        yield at, pa.Table.from_batches(held)


def _searched(pages: DataFrame, asked: DataFrame, tree: Directory, space: Space, k: int) -> DataFrame:
    """query, score, vec_id: up to k rows for each row of ``asked`` (pivot, cut,
    query, v, floor).  Pages and queries meet by page, entries first; a task
    holds one page and streams the queries over it."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, entries, page = None, [], None
        for batch in batches(source):
            rows = batch.to_pylist()
            out: list[tuple[int, int, int]] = []
            for r in rows:
                if (r["pivot"], r["cut"]) != at:
                    at, entries, page = (r["pivot"], r["cut"]), [], None
                if r["query"] is None:
                    entries.append(r)
                    continue
                if page is None:
                    if not entries:
                        continue
                    page = Page(
                        space,
                        *(np.array([e[c] for e in entries]) for c in ("node", "away", "up")),
                        *([e[c] for e in entries] for c in ("v", "ids")),
                    )
                    pivot = tree.pivots[at[0]]
                q = space.queries([r["v"]])[0]
                found = page.search(q, distances(q[None], pivot[None])[0, 0], r["floor"], k)
                out += [(r["query"], -s, x) for s, x in found]
            if out:
                columns = [pa.array(x, pa.int64()) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "score", "vec_id"])

    both = pages.withColumns({"query": F.lit(None).cast("long"), "floor": F.lit(None).cast("double")}).unionByName(
        asked, allowMissingColumns=True
    )
    order = ["pivot", "cut", F.col("query").asc_nulls_first(), "node", "away"]
    names = ["pivot", "cut", "query", "node", "away", "up", "v", "ids", "floor"]
    dealt = both.select(*names).repartition("pivot", "cut").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "query long, score long, vec_id long")


def _best(found: DataFrame, k: int) -> DataFrame:
    own = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("__n", F.row_number().over(own)).where(F.col("__n") <= k).drop("__n")


def top_k(rows: DataFrame, queries: DataFrame, k: int, page: int = PAGE, node: int = NODE, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the k rows of
    largest inner product, ties to the smaller vec_id, its own id left out.

    Both sides have vec_id and v (``integer_vectors``).  Rows without an id take
    no part.  Repeated rows count once; a query id with several vectors has a
    result for each.  Shorter vectors count as ended by zeros.
    """
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    queries, _ = stored(queries.where("vec_id IS NOT NULL").select("vec_id", "v").distinct(), "queries")
    own = queries.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    if own is None:
        return spark.createDataFrame([], schema)
    kept = k + own  # so many of the best hold k others than the query's own
    found, _ = stored(objects(rows.where("vec_id IS NOT NULL").select("vec_id", "v"), kept), "objects")
    size, width = found.count(), length(found)
    if not size:
        return spark.createDataFrame([], schema)

    def squares(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            own = matrix(batch.column(0).to_pylist(), width)
            yield pa.RecordBatch.from_arrays([pa.array([np.einsum("ij,ij->i", own, own).max()])], names=["s"])

    longest = found.select("v").mapInArrow(squares, "s double").agg(F.max("s")).first()[0]
    space = Space(width, longest)

    # Routing objects: a sample by hash, a few times as large as what is needed.
    wanted = min(pivots, math.ceil(size / page))
    share = min(1.0, (4 * wanted + 64) / size)
    sample = found.where(F.pmod(F.xxhash64("v", F.lit(7)), F.lit(1 << 30)) <= math.ceil(share * (1 << 30))).select("v")
    chosen = sorted(r[0] for r in sample.limit(8 * wanted + 256).collect()) or [found.first()[0]]
    chosen = [chosen[i] for i in np.random.default_rng(7).permutation(len(chosen))[:wanted]]
    tree = Directory(space, [bytes(x) for x in chosen])
    pages, _ = stored(_paged(_routed(found, tree, space, page), space, node), "pages")
    shape = pages.groupBy("pivot").agg(F.max("up").alias("radius"), (F.max("cut") + 1).alias("cuts")).collect()
    cuts = np.zeros(len(tree.pivots), dtype=np.int64)
    tree.radius[:] = -math.inf
    for r in shape:
        tree.radius[r["pivot"]], cuts[r["pivot"]] = r["radius"], r["cuts"]

    # Equal queries are asked once, under a number that the stored row keeps.
    distinct = queries.select("v").distinct()
    asked, _ = stored(distinct.withColumn("query", F.monotonically_increasing_id()), "asked")

    def at_home(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            pivot, _ = tree.descend(space.queries(batch.column(0).to_pylist()))
            columns = [pa.array(pivot), pa.array(np.zeros(len(pivot), dtype=np.int64)), batch.column(1), batch.column(0)]
            yield pa.RecordBatch.from_arrays(columns, names=["pivot", "cut", "query", "v"])

    lowest = F.lit(-math.inf).cast("double").alias("floor")
    home = asked.select("v", "query").mapInArrow(at_home, "pivot long, cut long, query long, v binary")
    first, first_path = stored(_searched(pages, home.select("*", lowest), tree, space, kept), "first")
    floors = first.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("least"))
    floor = F.when(F.col("n") == kept, F.col("least")).otherwise(F.lit(-math.inf).cast("double")).alias("floor")
    asked = home.select("pivot", "query", "v").join(floors, "query", "left").select("pivot", "query", "v", floor)
    asked, _ = stored(asked, "floors")

    def elsewhere(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches(source):
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                own, row, pivot, cut = batch.column(0).to_numpy(), [], [], []
                points = space.queries(batch.column(2).to_pylist())
                for i, (q, floor) in enumerate(zip(points, batch.column(3).to_numpy(), strict=True)):
                    near = tree.within(q, space.reach(q, floor) if math.isfinite(floor) else math.inf)
                    for p in near[cuts[near] > 0]:
                        more = range(1 if p == own[i] else 0, cuts[p])
                        row += [i] * len(more)
                        pivot += [int(p)] * len(more)
                        cut += more
                at = pa.array(row, pa.int64())
                taken = [batch.column(i).take(at) for i in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pivot, pa.int64()), pa.array(cut, pa.int64()), *taken], names=["pivot", "cut", "query", "v", "floor"]
                )

    # As many passes over the pages as keep what one of them shuffles in
    # proportion to the table, however many queries there are.
    passes = max(1, math.ceil(asked.count() * int(cuts.sum()) / (PAIRS + PAIRS_PER_VECTOR * size)))
    best, old = first, [first_path]
    for i in range(passes):
        part = asked.where(F.pmod(F.xxhash64("query"), F.lit(passes)) == i)
        pairs = part.mapInArrow(elsewhere, "pivot long, cut long, query long, v binary, floor double")
        best, path = stored(_best(best.unionByName(_searched(pages, pairs, tree, space, kept)), kept), "best")
        forget(spark, *old)
        old = [path]

    lists = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("found"))
    by_vector = lists.join(asked.select("query", "v"), "query").select("v", "found")
    out = join_skewed(queries, by_vector, "v")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("vec_id")), 1, k)
    return out.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("n", "x")).select(
        "query_id", (F.col("n") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.s")).alias("score")
    )


def top_of_table(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """``top_k`` with every row whose id ``every`` divides as a query.

    No row for an empty table; other columns play no part."""
    rows, _ = stored(integer_vectors(embeddings, FACTOR, ["vec_id"]), "vectors")
    return top_k(rows, rows.where(F.col("vec_id") % every == 0), k)
