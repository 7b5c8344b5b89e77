"""Exact top-k inner products: cover trees over queries and data, walked together."""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from cohortlens.session import materialise

#: Rows a data block and a query group are planned for, points of a leaf, top centres (at most) and rows of the
#: sample they are taken from (at most).
BLOCK_ROWS, QUERY_ROWS, LEAF, MAX_CENTRES, SAMPLE_ROWS = 2048, 512, 32, 2048, 20_000
#: A node's children lie within its radius divided by this.
BASE = 2.0
LONG = np.iinfo(np.int64)


def products(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact; beyond the range of 64 bits they stop at its ends."""
    width = min(q.shape[1], r.shape[1])
    q, r = q[:, :width], r[:, :width]
    top = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(r.astype(np.float64)).max(initial=0)) * width
    if top < 2**53:
        return (q.astype(np.float64) @ r.T.astype(np.float64)).astype(np.int64)
    if top < 2**62:
        return q @ r.T
    exact = q.astype(object) @ r.T.astype(object)
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows; shorter rows end in zeros."""
    width = min(a.shape[1], b.shape[1])
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a[:, :width] @ b[:, :width].T)
    return np.sqrt(np.maximum(square, 0))


def greedy_cover(x: np.ndarray, radius: float, most: int | None = None) -> tuple[np.ndarray, np.ndarray] | None:
    """Centres more than ``radius`` apart and the centre, not further than that, of each row; the first row is one.

    Rows are looked at in order, a block at a time. None if more than ``most`` centres are needed.
    """
    owner = np.full(len(x), -1)
    centres: list[int] = []
    open_ = np.arange(len(x))
    while len(open_):
        block, first = open_[:256], len(centres)
        near = distances(x[block], x[block]) <= radius
        np.fill_diagonal(near, True)
        for i in range(len(block)):
            if owner[block[i]] < 0:
                free = near[i] & (owner[block] < 0)
                owner[block[free]] = len(centres)
                centres.append(int(block[i]))
        if most is not None and len(centres) > most:
            return None
        rest = open_[256:]
        if len(rest):
            near = distances(x[rest], x[centres[first:]]) <= radius
            hit = near.any(axis=1)
            owner[rest[hit]] = first + near[hit].argmax(axis=1)
            rest = rest[~hit]
        open_ = rest
    return np.array(centres), owner


def cover_tree(x: np.ndarray) -> list[tuple]:
    """Nodes ``(centre row, radius, child nodes, rows)``, the root first; inner nodes have children, leaves rows.

    A node's radius reaches all rows below it. Its children's centres are more than radius / BASE
    apart and cover its rows at that distance, its own centre being the first; children of a
    single row are gathered in one leaf.
    """
    nodes: list[tuple] = []
    stack = [(np.arange(len(x)), None)]
    while stack:
        rows, parent = stack.pop()
        own = len(nodes)
        gaps = distances(x[rows], x[rows[:1]])[:, 0]
        radius = float(gaps.max())
        nodes.append((int(rows[0]), radius, [], rows))
        if parent is not None:
            nodes[parent][2].append(own)
        if len(rows) <= LEAF or radius == 0:
            continue
        centres, owner = greedy_cover(x[rows], radius / BASE)
        if len(centres) == len(rows) or len(centres) < 2:
            continue  # all rows are equally far from each other: one leaf
        nodes[own] = (int(rows[0]), radius, nodes[own][2], rows[:0])
        order = np.argsort(owner, kind="stable")
        sizes = np.bincount(owner)
        single = []
        for part in np.split(rows[order], np.cumsum(sizes)[:-1]):
            if len(part) > 1:
                stack.append((part, own))
            else:
                single.append(part)
        if single:
            rest = np.concatenate(single)
            nodes.append((int(rest[0]), float(distances(x[rest], x[rest[:1]]).max()), [], rest))
            nodes[own][2].append(len(nodes) - 1)
    return nodes


def pack(ids: np.ndarray, points: np.ndarray) -> bytes:
    """A block with its tree, integers in the smallest type that holds them."""
    kind = np.result_type(np.min_scalar_type(int(points.min(initial=0))), np.min_scalar_type(int(points.max(initial=0))), np.int8)
    return pickle.dumps((ids, points.astype(kind if kind.kind == "i" else np.int64), cover_tree(points.astype(np.float64))))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    ids, points, nodes = pickle.loads(data)
    return ids, points.astype(np.int64), nodes


def _below(nodes: list[tuple]) -> list[np.ndarray]:
    """All rows below each node; children come after their parents."""
    rows: list = [None] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        own = [nodes[i][3], *(rows[c] for c in nodes[i][2])]
        rows[i] = np.concatenate(own)
    return rows


class Best:
    """The k best candidates of each query: highest score, then least id."""

    def __init__(self, n: int, k: int, least: np.ndarray | None = None):
        self.k = k
        self.scores = [np.zeros(0, np.int64) for _ in range(n)]
        self.ids = [np.zeros(0, np.int64) for _ in range(n)]
        #: what a candidate must reach at least
        self.least = np.full(n, LONG.min) if least is None else least.copy()

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.scores[query], scores]), np.concatenate([self.ids[query], ids])
        # ~s counts down as s counts up, without leaving 64 bits
        order = np.lexsort((i, ~s))[: self.k]
        self.scores[query], self.ids[query] = s[order], i[order]
        if len(order) == self.k:
            self.least[query] = max(self.least[query], s[order[-1]])


def dual_search(queries: tuple, data: tuple, best: Best) -> None:
    """Walk both trees from the pair of roots, best bound first.

    No inner product of rows below two nodes exceeds that of the centres plus what the two covering
    radii allow. A pair of nodes is left out when this is below the worst kth score of the query
    node's rows; a candidate that equals the kth score may still win by its id.
    """
    (q_ids, q, q_nodes), (r_ids, r, r_nodes) = queries, data
    qf, rf = q.astype(np.float64), r.astype(np.float64)
    q_norm, r_norm = np.sqrt((qf * qf).sum(axis=1)), np.sqrt((rf * rf).sum(axis=1))
    q_below = _below(q_nodes)
    width = min(q.shape[1], r.shape[1])

    def bounds(a: int, others: list[int], flip: bool) -> np.ndarray:
        """Bounds of one node of one side with several of the other."""
        (x, xn, nodes), (y, yn, more) = ((rf, r_norm, r_nodes), (qf, q_norm, q_nodes)) if flip else ((qf, q_norm, q_nodes), (rf, r_norm, r_nodes))
        c, rad = nodes[a][0], nodes[a][1]
        cs, rads = np.array([more[o][0] for o in others]), np.array([more[o][1] for o in others])
        exact = y[cs][:, :width] @ x[c][:width]
        bound = exact + rad * yn[cs] + rads * xn[c] + rad * rads
        return bound + 1 + 1e-9 * (np.abs(exact) + xn[c] * yn[cs])  # more than rounding can take away

    heap = [(-float(bounds(0, [0], False)[0]), 0, 0)]
    while heap:
        bound, a, b = heapq.heappop(heap)
        if -bound < best.least[q_below[a]].min():
            continue
        inner_a, inner_b = q_nodes[a][2], r_nodes[b][2]
        if inner_b and (not inner_a or r_nodes[b][1] >= q_nodes[a][1]):
            for x, o in zip(bounds(a, inner_b, False), inner_b):
                heapq.heappush(heap, (-float(x), a, o))
        elif inner_a:
            for x, o in zip(bounds(b, inner_a, True), inner_a):
                heapq.heappush(heap, (-float(x), o, b))
        else:
            own, rows = q_nodes[a][3], r_nodes[b][3]
            scores = products(q[own], r[rows])
            fits = (scores >= best.least[own][:, None]) & (q_ids[own][:, None] != r_ids[rows][None, :])
            for i in np.flatnonzero(fits.any(axis=1)):
                best.add(int(own[i]), scores[i, fits[i]], r_ids[rows[fits[i]]])


def quantised(vectors: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """``id, vec``: each row's floor(scale * x), once; rows without an id or with unusable vectors left out."""
    v = F.col(vector)
    usable = F.col(id).isNotNull() & v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return vectors.filter(usable).select(F.col(id).cast("long").alias("id"), whole.alias("vec")).dropDuplicates(["id", "vec"])


def _matrix(column) -> np.ndarray:
    rows = [np.asarray(v, dtype=np.int64) for v in column]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def _top_centres(rows: DataFrame, n: int, size: int) -> np.ndarray:
    """Up to n / size centres of one cover, from a bounded sample in hash order."""
    want = int(min(MAX_CENTRES, max(1, -(-n // size))))
    sample = rows.orderBy(F.xxhash64("id", "vec"), "id").limit(SAMPLE_ROWS).select("vec").toPandas()
    x = _matrix(sample.vec).astype(np.float64)
    low, high, found = 0.0, float(distances(x, x[:1]).max(initial=0)), np.arange(1)
    for _ in range(16 if want > 1 else 0):
        radius = (low + high) / 2
        cover = greedy_cover(x, radius, want)
        if cover is None:
            low = radius
        else:
            high, found = radius, cover[0]
    return x[found]


def blocks(rows: DataFrame, size: int) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """Rows in blocks with a tree each, and the balls around the top centres they were dealt by.

    The table has ``node, chunk, n, centre, radius, packed``; the balls are the nodes' numbers, centres
    and radii. A row belongs to the nearest centre, and the rows of a centre are dealt into as many chunks
    as their number asks for, so that a centre which many rows are close to is many blocks.
    """
    n = rows.count()
    centres = _top_centres(rows, n, size)
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def place(frames):
        for pdf in frames:
            for part in np.array_split(np.arange(len(pdf)), len(pdf) // 1024 + 1):
                own = pdf.iloc[part]
                gaps = distances(_matrix(own["vec"]).astype(np.float64), shared.value)
                yield own.assign(node=gaps.argmin(axis=1).astype(np.int32), gap=gaps.min(axis=1))

    placed = materialise(rows.mapInPandas(place, "id long, vec array<long>, node int, gap double"), "placed")
    sums = placed.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias("chunks"), F.max("gap").alias("gap"))
    balls = sums.select("node", "gap").orderBy("node").toPandas()  # a row a centre, as in the broadcast
    dealt = placed.join(F.broadcast(sums.select("node", "chunks")), "node")
    dealt = dealt.select("node", F.pmod(F.xxhash64("id", "vec"), "chunks").cast("int").alias("chunk"), "id", "vec")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        points = _matrix(pdf["vec"])
        centre = points.mean(axis=0)
        radius = float(distances(points.astype(np.float64), centre[None, :]).max())
        own = (pdf["node"].iloc[0], pdf["chunk"].iloc[0], len(pdf), centre, radius, pack(pdf["id"].to_numpy(), points))
        return pd.DataFrame([own], columns=["node", "chunk", "n", "centre", "radius", "packed"])

    built = dealt.groupBy("node", "chunk").applyInPandas(build, "node int, chunk int, n long, centre array<double>, radius double, packed binary")
    nodes = balls["node"].to_numpy()
    return materialise(built, "blocks"), nodes, centres[nodes], balls["gap"].to_numpy() * (1 + 1e-9)


def ball_bounds(c: np.ndarray, rad: np.ndarray, d: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """For each two balls a number that no inner product of their members exceeds; a little more, for rounding."""
    width = min(c.shape[1], d.shape[1])
    exact = c[:, :width] @ d[:, :width].T
    cn, dn = np.sqrt((c * c).sum(axis=1))[:, None], np.sqrt((d * d).sum(axis=1))[None, :]
    return exact + rad[:, None] * dn + gap[None, :] * cn + rad[:, None] * gap[None, :] + 1 + 1e-9 * (np.abs(exact) + cn * dn)


def _vectors(column) -> np.ndarray:
    rows = [np.asarray(v, dtype=np.float64) for v in column]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def _first_nodes(groups: DataFrame, nodes: np.ndarray, centres: np.ndarray) -> DataFrame:
    """``gnode, gchunk, node``: the top centre with the highest product with each query group's centre."""
    shared = groups.sparkSession.sparkContext.broadcast((nodes, centres))

    def run(frames):
        nodes, centres = shared.value
        for pdf in frames:
            c = _vectors(pdf["gcentre"])
            width = min(c.shape[1], centres.shape[1])
            best = (c[:, :width] @ centres[:, :width].T).argmax(axis=1)
            yield pdf[["gnode", "gchunk"]].assign(node=nodes[best])

    return groups.select("gnode", "gchunk", "gcentre").mapInPandas(run, "gnode int, gchunk int, node int")


def _open_nodes(groups: DataFrame, nodes: np.ndarray, centres: np.ndarray, gaps: np.ndarray) -> DataFrame:
    """``gnode, gchunk, node``: the top centres whose balls may hold a score that some query of the group lacks."""
    shared = groups.sparkSession.sparkContext.broadcast((nodes, centres, gaps))

    def run(frames):
        nodes, centres, gaps = shared.value
        for pdf in frames:
            for part in np.array_split(np.arange(len(pdf)), len(pdf) // 256 + 1):
                own = pdf.iloc[part]
                bound = ball_bounds(_vectors(own["gcentre"]), own["gradius"].to_numpy(), centres, gaps)
                g, at = np.nonzero(bound >= own["worst"].to_numpy(dtype=np.float64)[:, None])
                yield own[["gnode", "gchunk"]].iloc[g].assign(node=nodes[at])

    return groups.select("gnode", "gchunk", "gcentre", "gradius", "worst").mapInPandas(run, "gnode int, gchunk int, node int")


def _ball_bound(q: str, r: str):
    """No inner product of rows in two balls is above this (one more for rounding)."""
    dot = F.aggregate(F.zip_with(f"{q}centre", f"{r}centre", lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
    norm = lambda c: F.sqrt(F.aggregate(f"{c}centre", F.lit(0.0), lambda s, x: s + x * x))
    rad = lambda c: F.col(f"{c}radius")
    size = norm(q) * norm(r)
    return dot + rad(q) * norm(r) + rad(r) * norm(q) + rad(q) * rad(r) + 1 + 1e-9 * size


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """Search each pair of a query group and a data block; ``least`` holds the scores that candidates must reach."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in pdf.itertuples():
            queries = unpack(row.queries)
            best = Best(len(queries[0]), k, None if row.least is None else np.frombuffer(row.least, np.int64))
            dual_search(queries, unpack(row.packed), best)
            sizes = [len(s) for s in best.scores]
            found = (np.repeat(queries[0], sizes), np.concatenate(best.ids), np.concatenate(best.scores))
            out.append((row.gnode, row.gchunk, row.node, row.chunk, *found, best.least.tobytes(), int(best.least.min())))
        return pd.DataFrame(out, columns=["gnode", "gchunk", "node", "chunk", "query", "id", "score", "least", "worst"])

    schema = "gnode int, gchunk int, node int, chunk int, query array<long>, id array<long>, score array<long>, least binary, worst long"
    return pairs.groupBy("gnode", "gchunk", "node", "chunk").applyInPandas(run, schema)


def top_inner_products(vectors: DataFrame, asks=None, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of each query with all other rows.

    Components are taken as floor(scale * x). ``asks`` is a condition that picks the queries (all rows
    without it). Ties go to the smaller id. Vectors that are null or hold null or non-finite components,
    and rows without an id, take no part; rows that repeat id and vector count once; rows that share a
    query's id are not its candidates; of vectors of different lengths the shorter ends in zeros. A query
    with fewer than k candidates has all of them. Scores beyond 64 bits stop at the range's ends. Further
    columns play no part. Ids must be whole numbers.

    Queries and data are each cut into blocks around the centres of one cover, and each block keeps its
    cover tree. A query group first searches the block whose centre promises most; its worst kth score
    then prunes centres, blocks and, in the blocks that remain, pairs of tree nodes.
    """
    spark = vectors.sparkSession
    rows = materialise(quantised(vectors, id, vector, scale), "vectors")
    asked = rows if asks is None else materialise(quantised(vectors.filter(asks), id, vector, scale), "asked")
    if asked.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    data, *balls = blocks(rows, BLOCK_ROWS)
    groups, *_ = blocks(asked, QUERY_ROWS)
    groups = groups.select(*[F.col(c).alias(f"g{c}") for c in ("node", "chunk", "centre", "radius")], F.col("packed").alias("queries"))
    group, block = ["gnode", "gchunk"], ["node", "chunk"]
    packed = data.select(*block, "packed")
    first = _first_nodes(groups, balls[0], balls[1]).withColumn("chunk", F.lit(0))
    seeds = first.join(groups.select(*group, "queries"), group).join(packed, block).withColumn("least", F.lit(None).cast("binary"))
    seeds = materialise(_searched(seeds, k), "seeds")
    known = groups.join(seeds.select(*group, "least", "worst"), group, "left").withColumn("worst", F.coalesce("worst", F.lit(int(LONG.min))))
    summary = known.drop("queries", "least")
    pairs = _open_nodes(summary, *balls).join(summary, group).join(data.drop("packed"), "node")
    pairs = pairs.filter(_ball_bound("g", "") >= F.col("worst")).select(*group, *block)
    pairs = pairs.join(seeds.select(*group, *block), [*group, *block], "left_anti")
    more = _searched(pairs.join(known.select(*group, "queries", "least"), group).join(packed, block), k)
    found = seeds.select("query", "id", "score").union(more.select("query", "id", "score"))
    found = found.select(F.explode(F.arrays_zip("query", "id", "score")).alias("f")).select("f.*")
    rank = F.row_number().over(W.Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
