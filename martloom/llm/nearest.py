"""Exact top-k inner products by best-first search in an M-tree.

Integer vectors get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, so that all lie
on one sphere; the Euclidean distance there falls as the inner product with a query rises, and a
metric tree finds the highest products exactly.

Tree: routing vectors at the root are a bounded sample of the vectors. Every vector goes to its
nearest one, and the vectors of a routing vector are cut into pages of bounded size (by hash, so equal
vectors spread as well). A page holds nodes; each node stores its routing vector, its covering radius
and its distance to its parent's routing vector, and each entry its distance to the node's. Search goes
through nodes by their smallest possible distance; |d(q, parent) - d(node, parent)| - radius rules
nodes and entries out before any distance to them is computed. What is left is compared by exact
integer products.

Queries first search the page they lie nearest to, which gives a bound on their k-th product, then
every other page whose bound can still beat it. Partial results are merged by rank.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import materialise

ROUTES = 64  # routing vectors at the root
PAGE = 2048  # vectors in a page, on average
NODE = 32  # entries in a node
QUERIES = 512  # queries that search one page together
SLACK = 1e-6  # relative allowance for rounding of distances


def integers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component; null for a vector that is null or has null or non-finite components."""
    good = F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False)
    )
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column as integers, shorter ones filled with zeros."""
    values = column.to_pylist() if hasattr(column, "to_pylist") else list(column)
    out = np.zeros((len(values), width), dtype=np.int64)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def lifted(rows: np.ndarray, largest: float) -> np.ndarray:
    """Vectors with the coordinate that puts all of them on one sphere."""
    square = np.einsum("ij,ij->i", rows.astype(np.float64), rows.astype(np.float64))
    return np.concatenate([rows.astype(np.float64), np.sqrt(np.maximum(largest - square, 0.0))[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2.0 * a @ b.T
    return np.sqrt(np.maximum(square, 0.0))


class Page:
    """A page of the tree: leaf nodes below one routing vector."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, largest: float, route: np.ndarray):
        points = lifted(rows, largest)
        to_route = distances(points, route[None, :])[:, 0]
        count = -(-len(ids) // NODE)
        # node centres: entries spread over the order of distance to the routing vector, then nearest centre
        centres = points[np.argsort(to_route, kind="stable")[np.linspace(0, len(ids) - 1, count).round().astype(int)]]
        between = distances(points, centres)
        owner = between.argmin(1)
        self.ids, self.rows = ids, rows
        self.members, self.to_centre, self.radius, self.centre, self.to_parent = [], [], [], [], []
        for c in np.unique(owner):
            inside = np.nonzero(owner == c)[0]
            self.members.append(inside)
            self.to_centre.append(between[inside, c])
            self.radius.append(between[inside, c].max())
            self.centre.append(centres[c])
        self.centre = np.array(self.centre)
        self.radius = np.array(self.radius)
        self.to_parent = distances(self.centre, route[None, :])[:, 0]
        self.slack = SLACK * max(1.0, largest**0.5)

    def search(self, query: np.ndarray, query_id: int, k: int, to_route: float, largest: float, bound: float | None) -> list[tuple[int, int]]:
        """Best-first: up to k (product, id), best first; nothing farther than `bound` matters."""
        lift = lifted(query[None, :], 0.0)[0]
        point_norm = float(lift @ lift)
        limit = np.inf if bound is None else bound
        best: list[tuple[int, int]] = []  # heap of (product, -id), worst first
        # the stored distance to the parent rules nodes out without computing theirs
        floor = np.abs(to_route - self.to_parent) - self.radius - self.slack
        open_ = np.nonzero(floor <= limit)[0]
        if not len(open_):
            return []
        to_node = distances(lift[None, :], self.centre[open_])[0]
        queue = sorted(zip(np.maximum(to_node - self.radius[open_] - self.slack, 0.0).tolist(), open_.tolist(), to_node.tolist()))
        for least, node, distance in queue:
            if least > limit:
                break
            members = self.members[node]
            near = members[np.abs(distance - self.to_centre[node]) - self.slack <= limit]
            if not len(near):
                continue
            products = self.rows[near] @ query
            for product, i in zip(products.tolist(), self.ids[near].tolist()):
                if i == query_id:
                    continue
                entry = (product, -i)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                limit = min(limit, reach(best[0][0], point_norm, largest) + self.slack)
        return [(p, -i) for p, i in sorted(best, reverse=True)]


def reach(product: float, query_square: float, largest: float) -> float:
    """Distance from the query (last coordinate zero) at which vectors have this product."""
    return float(np.sqrt(max(query_square + largest - 2.0 * product, 0.0)))


def _route_step(routes: np.ndarray, largest: float, width: int, every: bool):
    """Add the nearest routing vector and the distance to it, or with `every` all of them, nearest first."""
    points = lifted(routes, largest)

    def step(batches: Iterator):
        import pyarrow as pa

        for big in batches:
            for at in range(0, big.num_rows, 2048):
                batch = big.slice(at, 2048)
                rows = _matrix(batch.column(1), width)
                # a query's own last coordinate is zero, so that the order is that of the products
                mine = lifted(rows, largest) if not every else np.concatenate([rows.astype(np.float64), np.zeros((len(rows), 1))], axis=1)
                far = distances(mine, points)
                if every:
                    extra = [pa.array(far.tolist(), pa.list_(pa.float64()))]
                else:
                    near = far.argmin(1)
                    extra = [pa.array(near, pa.int32()), pa.array(far[np.arange(len(rows)), near], pa.float64())]
                names = ["far"] if every else ["route", "near"]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *extra], names=["id", "v", *names])

    return step


def top_products(vectors: DataFrame, ident: str, vector: str, queries: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where `queries` holds, its k highest products with other rows.

    Rows with the query's own id are no candidates for it; repeated ids are candidates each, and one
    query (with the smallest vector). Vectors shorter than the longest count as filled up with zeros.
    Null ids take no part.
    """
    usable = vectors.select(F.col(ident).cast("long").alias("id"), queries.alias("_q"), integers(F.col(vector), scale).alias("v"))
    usable = materialise(usable.filter("id is not null and v is not null"), "integer-vectors")
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    shape = usable.agg(F.max(F.size("v")).alias("width"), F.max(square).alias("largest"), F.count(F.lit(1)).alias("n")).first()
    out = "query_id long, rank int, vec_id long, score long"
    spark = usable.sparkSession
    if not shape["n"]:
        return spark.createDataFrame([], out)
    width, largest = shape["width"], float(shape["largest"])
    # a bounded sample, the same for the same rows
    sample = usable.select("id", "v").orderBy(F.xxhash64("id"), "id", "v").limit(ROUTES).collect()
    routes = np.unique(_matrix([r["v"] for r in sample], width), axis=0)
    route_points = lifted(routes, largest)

    placed = usable.select("id", "v").mapInArrow(_route_step(routes, largest, width, False), "id long, v array<long>, route int, near double")
    placed = materialise(placed, "routed")
    # one row for each routing vector
    sizes = placed.groupBy("route").agg(F.count(F.lit(1)).alias("_n"))
    pages = {r["route"]: max(1, -(-r["_n"] // PAGE)) for r in sizes.collect()}
    count = F.element_at(F.create_map(*[F.lit(x) for kv in pages.items() for x in kv]), F.col("route"))
    placed = placed.withColumn("page", F.pmod(F.xxhash64("id", "near"), count).cast("int"))
    directory = materialise(placed.groupBy("route", "page").agg(F.max("near").alias("radius"), F.min("near").alias("inner")), "page-directory")

    one = usable.filter("_q").groupBy("id").agg(F.min("v").alias("v"))
    asked = one.mapInArrow(_route_step(routes, largest, width, True), "id long, v array<long>, far array<double>")
    asked = materialise(asked, "queries").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(-(-shape["n"] // (100 * QUERIES)) + 1)).cast("int"))
    homes = asked.withColumn("route", (F.array_position("far", F.array_min("far")) - 1).cast("int"))

    def searched(requests: DataFrame) -> DataFrame:
        """requests: route, page, id, v, bound (null: none) -> product rows of each query in each page."""
        # a page is sent once to each block of queries that asks for it
        wanted = requests.select("route", "page", "block").distinct()
        entries = placed.join(wanted, ["route", "page"]).select(
            "route", "page", "block", "id", "v", F.lit(None).cast("double").alias("bound"), F.lit(False).alias("asks")
        )
        asks = requests.select("route", "page", "block", "id", "v", "bound", F.lit(True).alias("asks"))
        both = entries.unionByName(asks)
        return both.groupBy("route", "page", "block").applyInPandas(_page_step(route_points, largest, width, k), "query_id long, vec_id long, score long")

    home_page = homes.join(directory.groupBy("route").agg(F.min("page").alias("page")), "route")
    first = materialise(searched(home_page.withColumn("bound", F.lit(None).cast("double"))), "first-pages")
    worst = first.groupBy("query_id").agg(F.min("score").alias("_kth"), F.count(F.lit(1)).alias("_found"))
    norm = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    room = F.sqrt(F.greatest(norm + F.lit(largest) - 2.0 * F.col("_kth"), F.lit(0.0))) + F.lit(SLACK * max(1.0, largest**0.5))
    known = homes.join(worst, F.col("id") == F.col("query_id"), "left").withColumn("bound", F.when(F.col("_found") >= k, room))
    spread = known.select("id", "v", "block", "bound", F.col("route").alias("home"), F.posexplode("far").alias("_r", "_far"))
    lower = F.greatest(F.col("_far") - F.col("radius"), F.col("inner") - F.col("_far")) - F.lit(SLACK * max(1.0, largest**0.5))
    firsts = directory.groupBy("route").agg(F.min("page").alias("_first"))
    more = (
        spread.join(directory.join(firsts, "route"), F.col("_r") == F.col("route"))
        .filter((F.col("home") != F.col("route")) | (F.col("page") != F.col("_first")))
        .filter(F.col("bound").isNull() | (lower <= F.col("bound")))
        .select("route", "page", "block", "id", "v", "bound")
    )
    rest = materialise(searched(materialise(more, "page-requests")), "other-pages")
    # at most k rows for each query and page
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _page_step(route_points: np.ndarray, largest: float, width: int, k: int):
    def step(key, group):
        import pandas as pd

        rows = _matrix(group["v"], width)
        asks = group["asks"].to_numpy(dtype=bool)
        ids = group["id"].to_numpy(dtype=np.int64)
        found = []
        if asks.any() and not asks.all():
            route = route_points[key[0]]
            page = Page(ids[~asks], rows[~asks], largest, route)
            queries, bounds = rows[asks], group["bound"].to_numpy(dtype=float)[asks]
            lifted_queries = np.concatenate([queries.astype(np.float64), np.zeros((len(queries), 1))], axis=1)
            to_route = distances(lifted_queries, route[None, :])[:, 0]
            for q, i, far, bound in zip(queries, ids[asks].tolist(), to_route.tolist(), bounds.tolist()):
                for product, vec in page.search(q, i, k, far, largest, None if bound != bound else bound):
                    found.append((i, vec, product))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    return step
