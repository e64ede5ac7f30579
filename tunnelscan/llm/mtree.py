"""Exact top-k inner-product search with M-trees.

A vector component x becomes floor(256 * x); scores are integer inner products.
The largest inner product is the nearest neighbour in a metric space: with M the
largest norm, a vector v gets one more coordinate sqrt(M^2 - |v|^2) and a query
gets 0, so that distance^2 = |q|^2 + M^2 - 2 q.v.

Index: every vector goes to the nearest of some sampled routing vectors, in a
crowded region (over ``block_rows`` rows) to the nearest of further ones sampled in
that region, and a region that is crowded still, as of equal vectors, is split by
hash.  Each block so made is an M-tree of pages: a node has a centre, a covering
radius and its distance to its parent's centre; a leaf page has its vectors and
their distances to its centre.  The pages are rows of a staged table.

Search, near pages first, by all queries of a part together: a query skips a page
without computing its distance when |d(q, parent) - stored distance| - radius already
exceeds the distance of its k-th best score, and an entry that all queries of the page
may skip so is not scored.  The scores of a page are one matrix product.  Queries first search their own block, which
bounds the k-th score; then all blocks that the bound does not exclude, by the ball
of the region and by that of the block's root.  Queries of neighbouring regions are
searched together, so that they want the same blocks: a block's pages are sent once
to each part of the queries, of about ``QUERY_BLOCK``.

Distances are doubles, so every bound has a slack relative to the lengths; scores
are exact at any size, in Python's integers where 64 bits do not hold them.

Edge cases: a vector that is NULL or holds a NULL or non-finite component takes
no part, nor does one with a component of 2**45 or more (256 times it would not be
exact) or a NULL id; scores beyond 64 bits are returned as the nearest 64-bit
number, in either order; vectors of different lengths are not compared; rows
of the query's own id are no candidates; with fewer candidates than k all are
returned; equal scores go to the smaller id; repeated rows are candidates each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunnelscan.llm.common import LARGEST, batch_of, bounded, list_array, stage

TOP = 5
BLOCK_ROWS = 4096
# Routing vectors of the whole index: a bounded sample, sent to every task.
MAX_ROUTES = 1024
PAGE = 64
# Queries searched together in a block.
QUERY_BLOCK = 4096
# Scores of a page and its queries worked on at once.
SCORES = 1 << 20
# Bytes of vectors of a crowded region that one task routes further.
ROUTED_BYTES = 64 << 20
# Regions, 32 bytes each, broadcast up to this many.
MAX_BROADCAST = 500_000
# Slack of the bounds, far above the error of a distance: of distances, and of
# their squares relative to the squared lengths that they are made of.
SLACK = 1e-6
RELATIVE = 1e-12
_LONG = (-(1 << 63), (1 << 63) - 1)

# A block: its routing vector, the further one in a crowded region, the piece.
_BLOCK = ["route", "sub", "piece"]
_BLOCK_SQL = "route long, sub long, piece long"
_PAGES = pa.schema([*[(c, pa.int64()) for c in _BLOCK], ("node", pa.int32()), ("parent", pa.int32()),
                    ("centre", pa.list_(pa.float64())), ("radius", pa.float64()), ("up", pa.float64()), ("ids", pa.list_(pa.int64())),
                    ("vectors", pa.list_(pa.int64())), ("ups", pa.list_(pa.float64()))])
_PAGES_SQL = (_BLOCK_SQL + ", node int, parent int, centre array<double>, radius double, up double, ids array<long>, "
              "vectors array<long>, ups array<double>")
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_FOUND_SQL = "query_id long, vec_id long, score long"


def quantised(vec: Column) -> Column:
    """floor(256 * x) of every component; NULL where the vector takes no part."""
    usable = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < LARGEST))
    return F.when(vec.isNotNull() & usable, F.transform(vec, lambda x: F.floor(x.cast("double") * 256)))


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def lifted(v: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the coordinate that makes all norms equal."""
    v = v.astype(np.float64)
    rest = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", v, v), 0.0))
    return np.hstack([v, rest[:, None]])


def _within(square, best):
    """Distance up to which a candidate may score ``best``; ``square``: the squared
    lengths of query and candidate."""
    return np.sqrt(np.maximum(square - 2 * best, 0.0) + RELATIVE * square) + SLACK


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - centre) ** 2).sum(axis=1), 0.0))


def build(points: np.ndarray, page: int = PAGE, seed: int = 7):
    """Nodes (parent, centre, radius, distance to the parent's centre, rows of a
    leaf and their distances to the centre); the root is node 0."""
    rng = np.random.default_rng(seed)
    nodes = []

    def add(parent: int, rows: np.ndarray, centre: np.ndarray, up: float) -> None:
        d = _distances(points[rows], centre)
        here = len(nodes)
        leaf = len(rows) <= page or d.max() == 0.0
        nodes.append([parent, centre, float(d.max()), up, rows if leaf else None, d if leaf else None])
        if leaf:
            return
        # Routing objects: far from each other, as the first is drawn and each
        # next one is the row farthest from those before.
        count = min(16, max(2, len(rows) // page))
        routes = [points[rows[rng.integers(len(rows))]]]
        near = _distances(points[rows], routes[0])
        owner = np.zeros(len(rows), np.int64)
        while len(routes) < count and near.max() > 0.0:
            routes.append(points[rows[int(near.argmax())]])
            d = _distances(points[rows], routes[-1])
            owner[d < near] = len(routes) - 1
            near = np.minimum(near, d)
        if len(routes) == 1:
            nodes[here][4:] = [rows, _distances(points[rows], centre)]
            return
        for k, route in enumerate(routes):
            part = rows[owner == k]
            if len(part):
                add(here, part, route, float(_distances(route[None, :], centre)[0]))

    if len(points):
        add(-1, np.arange(len(points)), points.mean(axis=0), 0.0)
    return nodes


class Tree:
    """The pages of one block, searched by many queries together, near pages first."""

    def __init__(self, pages: pa.Table, dim: int, kind=np.int64):
        """``kind``: numbers in which all scores are exact."""
        pages = pages.sort_by("node")
        self.centre = _matrix(pages["centre"], dim + 1)
        self.radius = pages["radius"].to_numpy()
        self.up = pages["up"].to_numpy()
        parent = pages["parent"].to_numpy()
        self.children = [np.flatnonzero(parent == k) for k in range(len(parent))]
        column = lambda name: [x.values.to_numpy(zero_copy_only=False) for x in pages[name]]
        ids = column("ids")
        order = [np.argsort(x, kind="stable") for x in ids]     # ties go to smaller ids
        self.ids, self.ups = ([x[o] for x, o in zip(c, order)] for c in (ids, column("ups")))
        self.vectors = [x.reshape(len(o), dim)[o].astype(kind, copy=False) for x, o in zip(column("vectors"), order)]

    def search(self, own: np.ndarray, q: np.ndarray, most: float, top: int, bound: np.ndarray):
        """(query, id, score) of the ``top`` best of each query, those of ``bound`` or
        more; ``q`` and ``bound`` as ``kind``, the smallest ``bound`` for none."""
        points = np.hstack([q.astype(np.float64), np.zeros((len(q), 1))])
        square = np.einsum("ij,ij->i", points, points) + most
        best = Best(top, bound)
        every = np.arange(len(q))
        stack = [(0, every, _distances(points, self.centre[0]))]
        while stack:
            node, asks, d = stack.pop()
            limit = best.reach(square, asks)
            held = d - self.radius[node] <= limit
            asks, d, limit = asks[held], d[held], limit[held]
            if not len(asks):
                continue
            kids = self.children[node]
            if len(kids):
                found = []
                for k in kids.tolist():
                    # Without a distance first, then by the distance to the centre.
                    some = asks[np.abs(d - self.up[k]) - self.radius[k] <= limit]
                    if len(some):
                        x = _distances(points[some], self.centre[k])
                        found.append((float(x.mean()), k, some, x))
                stack += [(k, some, x) for _, k, some, x in sorted(found, key=lambda f: -f[0])]
                continue
            near = np.flatnonzero((np.abs(d[:, None] - self.ups[node]) <= limit[:, None]).any(axis=0))
            vectors, ids = self.vectors[node][near], self.ids[node][near]
            step = max(1, SCORES // max(1, len(ids)))
            for some in (asks[a:a + step] for a in range(0, len(asks), step)):
                scores = q[some] @ vectors.T
                row, at = _entries(scores, (scores >= best.least[some][:, None]) & (own[some][:, None] != ids), top)
                best.add(some[row], ids[at], scores[row, at])
        return best.row, best.id, best.score


def _entries(scores: np.ndarray, asked: np.ndarray, top: int):
    """Row and column of the entries ``asked`` for, of a row with more the ``top`` best;
    of equal ones the first."""
    many = np.flatnonzero(asked.sum(axis=1) > top)
    if len(many):
        x, used = scores[many], asked[many]
        least = x[used].min()
        ordered = np.sort(np.where(used, x, least), axis=1)[:, -top][:, None]
        ties = used & (x == ordered)
        over = used & (x > ordered)
        asked[many] = over | (ties & (ties.cumsum(axis=1) <= top - over.sum(axis=1)[:, None]))
    return np.nonzero(asked)


class Best:
    """The ``top`` best entries of each query, ties to smaller ids; ``least``: the score
    that an entry must have to be of interest."""

    def __init__(self, top: int, bound: np.ndarray):
        self.top, self.least = top, bound.copy()
        self.row, self.id, self.score = np.empty(0, np.int64), np.empty(0, np.int64), bound[:0]

    def reach(self, square: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Distance up to which a candidate may be of interest."""
        least = self.least[rows].astype(np.float64)
        any_of = least <= _LONG[0]
        return np.where(any_of, np.inf, _within(square[rows], np.where(any_of, 0.0, least)))

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(row):
            return
        # Only the queries with new entries are sorted again.
        again = np.zeros(len(self.least), bool)
        again[row] = True
        old = again[self.row]
        row, ids, score = (np.concatenate([x[old], new]) for x, new in ((self.row, row), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, row)) if score.dtype != object else np.array(
            sorted(range(len(row)), key=lambda k: (row[k], -score[k], ids[k])))
        row, ids, score = row[order], ids[order], score[order]
        start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        rank = np.arange(len(row)) - np.repeat(start, np.diff(np.r_[start, len(row)]))
        last = rank == self.top - 1
        self.least[row[last]] = np.maximum(self.least[row[last]], score[last])
        kept = rank < self.top
        self.row, self.id, self.score = (np.concatenate([x[~old], new[kept]]) for x, new in (
            (self.row, row), (self.id, ids), (self.score, score)))


def _nearest(p: np.ndarray, routes: np.ndarray) -> np.ndarray:
    square = (p ** 2).sum(axis=1)[:, None] + (routes ** 2).sum(axis=1)[None, :] - 2 * p @ routes.T
    return square.argmin(axis=1)


def _route(routes: np.ndarray, most: float, dim: int):
    kinds = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("asks", pa.bool_()), ("route", pa.int64()),
                       ("d", pa.float64())])

    def run(batches):
        for batch in batches:
            v = _matrix(batch.column(1), dim)
            for a in range(0, len(v), 4096):
                p = lifted(v[a:a + 4096], most)
                near = _nearest(p, routes)
                d = np.sqrt(((p - routes[near]) ** 2).sum(axis=1))
                yield batch_of(kinds, *(batch.column(k).slice(a, len(p)) for k in range(3)), near, d)
    return run


def _route_further(most: float, dim: int):
    """The further routing vector, named by its id, that is nearest; -1 without any."""
    def run(key, rows, subs):
        subs = subs.sort_by("sub")
        names, places = subs["sub"].to_numpy(), lifted(_matrix(subs["v"], dim), most)
        v = _matrix(rows["v"], dim)
        near = [names[_nearest(lifted(v[a:a + 4096], most), places)] if len(names) else np.full(len(v[a:a + 4096]), -1)
                for a in range(0, len(v), 4096)]
        near = pa.array(np.concatenate([np.empty(0, np.int64), *near]), pa.int64())
        return rows.select(["vec_id", "v", "asks", "route"]).append_column("sub", near)
    return run


def _index(most: float, dim: int, page: int):
    def run(key, table):
        ids, v = table["vec_id"].to_numpy(), _matrix(table["v"], dim)
        p = lifted(v, most)
        rows = []
        for k, (parent, centre, radius, up, at, ups) in enumerate(build(p, page)):
            rows.append({**dict(zip(_BLOCK, (c.as_py() for c in key))), "node": k, "parent": parent, "centre": centre,
                         "radius": radius, "up": up, "ids": [] if at is None else ids[at],
                         "vectors": [] if at is None else v[at].ravel(), "ups": [] if at is None else ups})
        return pa.Table.from_pylist(rows, schema=_PAGES)
    return run


def _search(most: float, dim: int, top: int, kind):
    def run(key, pages, queries):
        out = [np.empty(0, np.int64)] * 3
        if pages.num_rows and queries.num_rows:
            own = queries["query_id"].to_numpy()
            # A score at an end of 64 bits stands for all beyond it.
            bound = np.array([_LONG[0] if b is None else b for b in queries["bound"].to_pylist()], object)
            if kind is not np.int64:
                bound = np.where(bound == _LONG[0], -np.inf, bound)
            row, ids, score = Tree(pages, dim, kind).search(
                own, _matrix(queries["q"], dim).astype(kind), most, top, bound.astype(kind))
            out = own[row], ids, np.clip(score, *_LONG).astype(np.int64) if kind is object else score.astype(np.int64)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, _FOUND)], schema=_FOUND)
    return run


def _candidates(routes: np.ndarray, radius: np.ndarray, most: float, dim: int):
    """The routes whose ball may hold a score of the bound or more."""
    kinds = pa.schema([("asked", pa.struct([("query_id", pa.int64()), ("part", pa.int64())])), ("q", pa.list_(pa.int64())),
                       ("bound", pa.int64()), ("routes", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            q = _matrix(batch.column(1), dim).astype(np.float64)
            bound = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
            square = (q ** 2).sum(axis=1)
            limit = np.where(np.isnan(bound), np.inf, _within(square + most, np.nan_to_num(bound)))
            lists = []
            for k in range(len(q)):
                d = np.sqrt(np.maximum(((routes - np.r_[q[k], 0.0]) ** 2).sum(axis=1), 0.0))
                lists.append(np.flatnonzero(d - radius <= limit[k]))
            offs = np.cumsum([0] + [len(x) for x in lists])
            yield batch_of(kinds, batch.column(0), batch.column(1), batch.column(2),
                           list_array(np.concatenate(lists) if lists else np.empty(0, np.int64), offs, pa.int64()))
    return run


def _admitted(most: float, dim: int):
    """The blocks of a region whose root's ball may hold a score of the bound or more."""
    kinds = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.int64())), ("bound", pa.int64()), ("part", pa.int64()),
                       *[(c, pa.int64()) for c in _BLOCK]])

    def run(key, queries, roots):
        q = _matrix(queries["q"], dim).astype(np.float64)
        bound = queries["bound"].to_numpy().astype(np.float64)
        square = (q ** 2).sum(axis=1)
        limit = np.where(np.isnan(bound), np.inf, _within(square + most, np.nan_to_num(bound)))
        centres, radius = _matrix(roots["centre"], dim + 1), roots["radius"].to_numpy()
        at, block = [], []
        for k in range(len(q) if len(radius) else 0):
            found = np.flatnonzero(_distances(centres, np.r_[q[k], 0.0]) - radius <= limit[k])
            at.append(np.full(len(found), k))
            block.append(found)
        at, block = (np.concatenate([np.empty(0, np.int64), *x]) for x in (at, block))
        queries, roots = queries.take(at), roots.take(block)
        return pa.table([*(queries[c] for c in ("query_id", "q", "bound", "part")), *(roots[c] for c in _BLOCK)],
                        schema=kinds)
    return run


def _chain(routes: np.ndarray) -> list[int]:
    """The routing vectors in an order in which near ones follow each other."""
    left, order = set(range(1, len(routes))), [0]
    while left:
        rest = np.fromiter(left, np.int64, len(left))
        order.append(int(rest[_distances(routes[rest], routes[order[-1]]).argmin()]))
        left.remove(order[-1])
    return order


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP,
          block_rows: int = BLOCK_ROWS, max_routes: int = MAX_ROUTES, page: int = PAGE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``top`` best candidates
    of every row of ``vectors`` for which ``is_query`` (over its columns) holds."""
    usable = stage(vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                                  quantised(F.col(f"`{vec_col}`")).alias("v"), is_query.alias("asks"))
                   .where("vec_id is not null and v is not null"), "vectors")
    sizes = usable.groupBy(F.size("v").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("most"),
        F.max(F.array_max(F.transform("v", F.abs))).alias("largest")).collect()
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for dim, n, most, largest in sizes:
        rows = usable.where(F.size("v") == dim)
        # Doubles where all sums are whole numbers that they hold, else 64 bits or Python's integers.
        size = (largest or 0) ** 2 * dim
        kind = np.float64 if size < 1 << 53 else np.int64 if size < 1 << 63 else object
        out = out.unionByName(_top_k(rows, dim, n, float(most), kind, top, block_rows, max_routes, page))
    return out


def _top_k(rows: DataFrame, dim: int, n: int, most: float, kind, top: int, block_rows: int, max_routes: int,
           page: int) -> DataFrame:
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(max_routes, -(-n // block_rows))).toArrow()
    routes = lifted(_matrix(sample["v"], dim), most)
    spark = rows.sparkSession
    routed = stage(rows.select("vec_id", "v", "asks").mapInArrow(
        _route(routes, most, dim), "vec_id long, v array<long>, asks boolean, route long, d double"), "routed")
    # At most ``max_routes`` rows: size, queries and covering radius of each region.
    regions = routed.groupBy("route").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked"), F.max("d").alias("radius")).collect()
    radius = np.full(len(routes), -np.inf)
    for r in regions:
        radius[r["route"]] = r["radius"]
    placed = routed.select("vec_id", "v", "asks", "route", F.lit(-1).cast("long").alias("sub"))
    per_task = max(block_rows, ROUTED_BYTES // (8 * max(1, dim)))
    crowded = [(r["route"], -(-r["n"] // per_task)) for r in regions if r["n"] > block_rows]
    if crowded:
        tasks = F.broadcast(spark.createDataFrame(crowded, "route long, tasks long"))
        some = routed.join(tasks, "route")
        # One row in ``block_rows`` by hash; of equal vectors one.
        subs = stage(some.where(F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(block_rows)) == 0)
                     .groupBy("route", "v", "tasks").agg(F.min("vec_id").alias("sub")), "further")
        subs = subs.select("route", "v", "sub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1))
                           .alias("task"))
        some = some.withColumn("task", F.pmod(F.xxhash64("vec_id"), "tasks"))
        further = some.groupBy("route", "task").cogroup(subs.groupBy("route", "task")).applyInArrow(
            _route_further(most, dim), "vec_id long, v array<long>, asks boolean, route long, sub long")
        placed = placed.join(tasks, "route", "left_anti").select(*placed.columns).unionByName(further)
    placed = stage(placed, "placed")
    sizes = stage(placed.groupBy("route", "sub").agg(F.count(F.lit(1)).alias("n")), "sizes")
    pieces = F.when(F.col("n") > 2 * block_rows, F.ceil(F.col("n") / block_rows)).otherwise(1)
    blocks = placed.join(bounded(sizes.withColumn("pieces", pieces).drop("n"), MAX_BROADCAST), ["route", "sub"])
    blocks = blocks.withColumn("piece", F.pmod(F.xxhash64("vec_id"), "pieces"))
    pages = stage(blocks.select(*_BLOCK, "vec_id", "v").groupBy(*_BLOCK)
                  .applyInArrow(_index(most, dim, page), _PAGES_SQL), "pages")

    # Parts of the queries: about QUERY_BLOCK of regions that follow each other.
    asked_of, before, spans = {r["route"]: r["asked"] for r in regions}, 0, []
    for route in _chain(routes):
        if asked_of.get(route):
            spans.append((route, before, asked_of[route]))
            before += asked_of[route]
    spans = F.broadcast(spark.createDataFrame(spans, "route long, before long, asked long"))
    part = F.floor((F.col("before") + F.pmod(F.xxhash64("query_id"), "asked")) / QUERY_BLOCK).alias("part")
    first = (blocks.where("asks").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), *_BLOCK)
             .join(spans, "route").select("query_id", "q", F.lit(None).cast("long").alias("bound"), part, *_BLOCK).distinct())
    first = stage(first, "first")

    def searched(queries: DataFrame) -> DataFrame:
        # A block's pages go to each part of its queries.
        copies = pages.join(queries.select(*_BLOCK, F.col("part").alias("to")).distinct(), _BLOCK)
        return (copies.groupBy(*_BLOCK, "to").cogroup(queries.groupBy(*_BLOCK, "part"))
                .applyInArrow(_search(most, dim, top, kind), _FOUND_SQL))

    found = stage(searched(first), "found")
    bounds = _best(found, top).groupBy("query_id").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
    bounds = bounds.select("query_id", F.when(F.col("n") >= top, F.col("low")).alias("bound"))
    near = (first.groupBy("query_id", "q").agg(F.min("part").alias("part")).join(bounds, "query_id", "left")
            .select(F.struct("query_id", "part").alias("asked"), "q", "bound")
            .mapInArrow(_candidates(routes, radius, most, dim),
                        "asked struct<query_id: long, part: long>, q array<long>, bound long, routes array<long>")
            .select("asked.query_id", "q", "bound", "asked.part", F.explode("routes").alias("route")))
    near = stage(near, "near")
    roots = pages.where("node = 0").select(*_BLOCK, "centre", "radius").join(
        near.select("route", F.col("part").alias("to")).distinct(), "route")
    second = (near.groupBy("route", "part").cogroup(roots.groupBy("route", "to"))
              .applyInArrow(_admitted(most, dim), f"query_id long, q array<long>, bound long, part long, {_BLOCK_SQL}")
              .join(first.select("query_id", "q", *_BLOCK), ["query_id", "q", *_BLOCK], "left_anti"))
    more = searched(stage(second, "second"))
    return _best(found.unionByName(more), top).select("query_id", "rank", "vec_id", "score")


def op5_mtree(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("vec_id") % 50 == 0)

