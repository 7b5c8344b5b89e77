"""Exact nearest neighbours and what is built on the neighbour graph."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.levels import bounded_levels, with_levels
from ..functions.ranks import attach, grouped_quantiles, value_ranks
from ..session import materialise
from . import communities, small_graphs

#: Least rows of a block; blocks grow to ``BLOCK_GROWTH`` times as many, so that large tables meet in no more of them.
BLOCK = 4_000
BLOCK_GROWTH = 8
BLOCKS = 24
MAX_PIVOTS = 1024
ROWS_PER_PIVOT = 5_000
#: Distances held at once by a task.
CHUNK = 4_000_000
#: Rows of a leaf, and the most dimensions in which boxes around leaves tell near from far.
LEAF = 128
LEAF_DIMS = 16
#: Leaves that a leaf of queries meets at once; their distances stay in a core's cache.
AT_ONCE = 16


def _assign(df: DataFrame, pivots: np.ndarray, extra: Sequence[str], kind: str) -> DataFrame:
    """Nearest pivot of each vector and the distance to it."""

    def run(it):
        for pdf in it:
            for s in range(0, len(pdf), 2048):
                part = pdf.iloc[s : s + 2048]
                d = _distances(np.stack(part["vec"].to_numpy()).astype(float), pivots)
                best = d.argmin(axis=1)
                yield part.assign(pivot=best.astype("int32"), reach=d[np.arange(len(part)), best])

    cols = "".join(f", {c} string" for c in extra)
    return df.select("cell", "vec", *extra).mapInPandas(run, f"cell string, vec {kind}{cols}, pivot int, reach double")


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T, 0))


def _leaves(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers leaf by leaf, and where each leaf begins and the last ends: halves along the widest side until they are small."""
    order, todo, starts = np.arange(len(x)), [(0, len(x))], []
    while todo:
        a, b = todo.pop()
        if b - a <= size:
            starts.append(a)
            continue
        part = x[order[a:b]]
        side = part[:, np.ptp(part, axis=0).argmax()]
        half = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(side, half)]
        todo += [(a, a + half), (a + half, b)]
    return order, np.append(np.sort(starts), len(x))


class _Search:
    """What the tasks of one neighbour search share: pivots, radii of their reference cells, blocks."""

    def __init__(self, pivots: np.ndarray, radius: np.ndarray, near: np.ndarray, members: np.ndarray, k: int, exclude: str | None):
        self.pivots, self.radius, self.near, self.members = pivots, radius, near, members
        self.k, self.exclude = k, exclude
        self.between = _distances(pivots, pivots)

    def floors(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Least distance of each query to a reference cell of each pivot: by the ball around the pivot, and by the plane between it and the query's own."""
        to = _distances(x, self.pivots)
        mine = to[np.arange(len(x)), own][:, None]
        gap = self.between[own]
        scale = 1e-6 * (1 + np.abs(x).max(initial=0) * np.sqrt(x.shape[1]) + np.abs(self.pivots).max() * np.sqrt(x.shape[1]))
        plane = np.where(gap > 1e3 * scale, (to * to - mine * mine) / (2 * np.maximum(gap, 1e3 * scale)), 0.0)
        return np.maximum(to - self.radius[None, :], plane) - scale  # slack for rounding

    def nearest(self, left: pd.DataFrame, right: pd.DataFrame, x: np.ndarray, limit: np.ndarray, floors: np.ndarray | None):
        """``row, neighbor, distance`` of the k nearest rows of ``right`` within each row's ``limit``, ties to the smaller name."""
        k = self.k
        right = right.sort_values("cell", kind="mergesort")
        y, names, home = np.stack(right["vec"].to_numpy()).astype(float), right["cell"].to_numpy(), right["pivot"].to_numpy()
        own_names = left["cell"].to_numpy()
        codes = None
        if self.exclude and self.exclude != "cell":
            codes = pd.factorize(np.concatenate([left[self.exclude].to_numpy(), right[self.exclude].to_numpy()]))[0]
            codes = codes[: len(left)], codes[len(left) :]
        if len(y) >= 8 * LEAF and y.shape[1] <= LEAF_DIMS and np.isfinite(x).all() and np.isfinite(y).all():
            if self.exclude == "cell":
                codes = pd.factorize(np.concatenate([own_names, names]), use_na_sentinel=False)[0]
                codes = codes[: len(left)], codes[len(left) :]
            row, ref, dist = self._by_leaves(x, y, limit, codes)
            return row, names[ref], dist
        want = k + (1 if self.exclude == "cell" else 0)
        found = []
        for p in np.unique(home) if floors is not None else [None]:
            refs = np.arange(len(y)) if p is None else np.flatnonzero(home == p)
            rows = np.arange(len(x)) if p is None else np.flatnonzero(floors[:, p] <= limit)
            yp, y2 = y[refs], (y[refs] ** 2).sum(axis=1)
            step = max(1, CHUNK // len(refs))
            for s in range(0, len(rows), step):
                at = rows[s : s + step]
                xs = x[at]
                x2 = (xs * xs).sum(axis=1)
                slack = 1e-12 * (x2 + y2.max()) + 1e-300
                d = xs @ yp.T
                d *= -2
                d += x2[:, None]
                d += y2[None, :]
                if codes is not None:
                    same = codes[0][at][:, None] == codes[1][refs][None, :]
                    d[same & (codes[0][at] >= 0)[:, None]] = np.inf
                bar = limit[at] ** 2 * (1 + 1e-9) + slack
                close = d <= bar[:, None]
                if np.count_nonzero(close) > 16 * want * len(at) and want < len(refs):
                    bar = np.minimum(bar, np.partition(d, want - 1, axis=1)[:, want - 1] + 2 * slack)
                    close = d <= bar[:, None]
                close &= np.isfinite(d)
                i, j = np.nonzero(close)
                for c in range(0, len(i), 100_000):
                    a, b = at[i[c : c + 100_000]], refs[j[c : c + 100_000]]
                    if self.exclude == "cell":
                        other = own_names[a] != names[b]
                        a, b = a[other], b[other]
                    found.append((a, b, np.sqrt(((y[b] - x[a]) ** 2).sum(axis=1))))
                if len(found) > 64:
                    found = [self._best(found)]
        row, ref, dist = self._best(found)
        return row, names[ref], dist

    def _by_leaves(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray, codes: tuple[np.ndarray, np.ndarray] | None):
        """``row, ref, distance`` as ``nearest``: queries that lie together meet the leaves around them first, then those whose boxes are within the kth distance."""
        ask, cuts = _leaves(x, LEAF)
        refs, starts = _leaves(y, LEAF)
        y, of = y[refs], None if codes is None else codes[1][refs]
        y2 = (y * y).sum(axis=1)
        low, high = np.minimum.reduceat(y, starts[:-1]), np.maximum.reduceat(y, starts[:-1])
        wide = np.column_stack([y, y2, np.ones(len(y))]).T  # squared distances in one product
        centre = (low + high) / 2
        first, k, out = max(AT_ONCE, -(-8 * self.k // LEAF)), self.k, []

        def meet(at, leaves, xs, wx, slack, bar, narrow):
            """Pairs within each row's bar; with ``narrow``, or when there are many, the bar lowered to the kth distance among them."""
            to = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in leaves])
            d = wx @ wide[:, to]
            mine = None if codes is None else np.where(codes[0][at] >= 0, codes[0][at], -2)
            if narrow or np.count_nonzero(d <= bar[:, None]) > 16 * k * len(at):
                if mine is not None:
                    d[mine[:, None] == of[to][None, :]] = np.inf
                if k <= len(to):
                    bar = np.minimum(bar, np.partition(d, k - 1, axis=1)[:, k - 1] + 2 * slack)
            i, j = np.divmod(np.flatnonzero(d <= bar[:, None]), len(to))
            j = to[j]
            if mine is not None:
                other = mine[i] != of[j]
                i, j = i[other], j[other]
            return bar, (at[i], refs[j], np.sqrt(((y[j] - xs[i]) ** 2).sum(axis=1)))

        for a, b in zip(cuts[:-1], cuts[1:]):
            at = ask[a:b]
            xs = x[at]
            x2 = (xs * xs).sum(axis=1)
            wx = np.column_stack([-2 * xs, np.ones(len(xs)), x2])
            slack = 1e-12 * (x2 + y2.max()) + 1e-300
            bar = limit[at] ** 2 * (1 + 1e-9) + slack
            gap = np.maximum(np.maximum(low - xs.max(axis=0), xs.min(axis=0) - high), 0)
            floor = (gap * gap).sum(axis=1)
            order = np.argsort(((centre - xs.mean(axis=0)) ** 2).sum(axis=1), kind="stable")
            order = order[floor[order] <= bar.max()]
            found = []
            if len(order):
                bar, some = meet(at, order[:first], xs, wx, slack, bar, True)
                found.append(some)
            rest = order[first:][floor[order[first:]] <= bar.max()]
            gap = np.maximum(np.maximum(low[rest][None] - xs[:, None], xs[:, None] - high[rest][None]), 0)
            rest = rest[((gap * gap).sum(axis=2) <= bar[:, None]).any(axis=0)]
            for s in range(0, len(rest), AT_ONCE):
                bar, some = meet(at, rest[s : s + AT_ONCE], xs, wx, slack, bar, False)
                found.append(some)
            out.append(self._best(found))
        row, ref, dist = (np.concatenate(z) for z in zip(*out)) if out else self._best([])
        order = np.argsort(row, kind="stable")
        return row[order], ref[order], dist[order]

    def _best(self, found):
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        row, ref, dist = (np.concatenate(z) for z in zip(*found))
        order = np.lexsort((ref, dist, row))
        row, ref, dist = row[order], ref[order], dist[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        return row[first], ref[first], dist[first]

    def kth(self, n: int, row: np.ndarray, dist: np.ndarray) -> np.ndarray:
        """Distance of the kth found neighbour of each of n rows; infinite with fewer."""
        out, count = np.full(n, np.inf), np.bincount(row, minlength=n)
        last = np.cumsum(count) - 1
        out[count >= self.k] = dist[last[count >= self.k]]
        return out

    def at_home(self, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Neighbours of each query in its own block, the kth distance, and the other blocks that may hold nearer ones."""
        n = len(left)
        x, own = np.stack(left["vec"].to_numpy()).astype(float), left["pivot"].to_numpy()
        if len(right):
            row, names, dist = self.nearest(left, right, x, np.full(n, np.inf), None)
        else:
            row, names, dist = np.zeros(0, int), np.zeros(0, object), np.zeros(0)
        limit = self.kth(n, row, dist)
        open_ = np.flatnonzero(np.isinf(limit))
        want = self.near.shape[1]
        for s in range(0, len(open_) if want else 0, 256):
            part = open_[s : s + 256]
            reach = (_distances(x[part], self.pivots)[:, :, None] + self.near[None]).reshape(len(part), -1)
            limit[part] = np.partition(reach, want - 1, axis=1)[:, want - 1] * (1 + 1e-6)
        targets = []
        for s in range(0, n, 2048):
            part = slice(s, s + 2048)
            visit = (self.floors(x[part], own[part]) <= limit[part][:, None]).astype(np.float32) @ self.members > 0
            visit[np.arange(len(visit)), left["block"].to_numpy()[part]] = False
            i, j = np.nonzero(visit)
            targets += np.split(j.astype("int32"), np.searchsorted(i, np.arange(1, len(visit))))
        cut = np.searchsorted(row, np.arange(1, n))
        return left.drop(columns=["qb", "block"]).assign(limit=limit, blocks=targets, names=np.split(names, cut), dists=np.split(dist, cut))

    def elsewhere(self, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"cell": [], "neighbor": [], "distance": []}).astype({"cell": str, "neighbor": str, "distance": float})
        x, own = np.stack(left["vec"].to_numpy()).astype(float), left["pivot"].to_numpy()
        row, names, dist = self.nearest(left, right, x, left["limit"].to_numpy(), self.floors(x, own))
        return pd.DataFrame({"cell": left["cell"].to_numpy()[row], "neighbor": names, "distance": dist})


def _blocks(count: np.ndarray, between: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each pivot: large ones are cut, small ones packed with their neighbours."""
    first, parts = np.zeros(len(count), int), np.ones(len(count), int)
    todo, at, used, block = set(range(len(count))), 0, 0, 0
    while True:
        todo.discard(at)
        if used and used + count[at] > size:
            block, used = block + 1, 0
        first[at], parts[at] = block, max(1, -(-int(count[at]) // size))
        if parts[at] > 1:
            block, used = block + int(parts[at]), 0
        else:
            used += int(count[at])
        if not todo:
            return first, parts
        rest = np.fromiter(todo, int)
        at = int(rest[between[at, rest].argmin()])


def knn(query: DataFrame, ref: DataFrame, k: int, exclude: str | None = "cell") -> DataFrame:
    """The k nearest reference cells of each query cell: ``(cell, neighbor, distance, rank)``.

    Both inputs have ``cell`` and ``vec``; rows whose ``exclude`` column equals the
    query's are no neighbours.  Exact: cells go to their nearest pivot, and pivots that lie
    together share a block of bounded size.  A query first meets its own block; its kth
    distance there and the triangle inequality tell which other blocks may hold nearer cells,
    and only those it meets.  A pivot holding most rows becomes many blocks.  Ties go to the
    smaller name.
    """
    extra = [exclude] if exclude and exclude != "cell" else []
    single = all(d.schema["vec"].dataType.simpleString() == "array<float>" for d in (query, ref))
    kind = "array<float>" if single else "array<double>"
    cast = lambda d: d.select(
        F.col("cell").cast("string").alias("cell"), F.col("vec").cast(kind).alias("vec"),
        *[F.col(c).cast("string").alias(c) for c in extra],
    )
    q0, r0 = cast(query), cast(ref)
    n_ref = r0.count()
    n_pivots = max(1, min(MAX_PIVOTS, n_ref // ROWS_PER_PIVOT))
    picked = r0.orderBy(F.xxhash64("cell"), "cell").limit(n_pivots).select("vec").collect()
    if not picked:
        return q0.limit(0).select("cell", F.col("cell").alias("neighbor"), F.lit(0.0).alias("distance"), F.lit(1).alias("rank"))
    pivots = np.array([x[0] for x in picked], dtype=float)
    n_pivots = len(pivots)
    r = materialise(_assign(r0, pivots, extra, kind), "ref")
    # aliased, for both sides of a cogroup must be told apart
    q = r.select(*[F.col(c).alias(c) for c in r.columns]) if query is ref else materialise(_assign(q0, pivots, extra, kind), "query")
    count, radius, asked = np.zeros(n_pivots, int), np.full(n_pivots, -np.inf), np.zeros(n_pivots, int)
    for x in r.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("u")).collect():
        count[x.pivot], radius[x.pivot] = x.n, x.u
    for x in q.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect():
        asked[x.pivot] = x.n
    # distances from each pivot to its nearest cells bound those of queries whose block holds too few
    want = 0 if extra else k + (1 if exclude == "cell" else 0)
    near = np.full((n_pivots, want), np.inf)
    if want and n_pivots > 1:
        order = W.partitionBy("pivot").orderBy("reach", "cell")
        for x in r.select("pivot", "reach", "cell").withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= want).select("pivot", "_r", "reach").collect():
            near[x[0], x[1] - 1] = x[2]
    size = max(BLOCK, min(BLOCK_GROWTH * BLOCK, n_ref // BLOCKS))
    first, parts = _blocks(count, _distances(pivots, pivots), size)
    n_blocks = int((first + parts).max())
    members = np.zeros((n_pivots, n_blocks), np.float32)
    load = np.zeros(n_blocks)
    for j in range(n_pivots):
        members[j, first[j] : first[j] + parts[j]] = count[j] > 0
        load[first[j] : first[j] + parts[j]] += asked[j] / parts[j]
    search = _Search(pivots, radius, near, members, k, exclude)
    spark = query.sparkSession
    spec = F.broadcast(spark.createDataFrame([(j, int(first[j]), int(parts[j])) for j in range(n_pivots)], "pivot int, _first int, _parts int"))
    own = (F.col("_first") + F.pmod(F.xxhash64("cell"), F.col("_parts"))).cast("int")
    spread = lambda n: F.broadcast(spark.createDataFrame([(b, int(v)) for b, v in n.items()], "block int, _q int"))
    part = F.pmod(F.xxhash64(F.lit(1), "cell"), F.col("_q")).cast("int").alias("qb")
    fields = ["cell", "vec", *extra, "pivot"]
    refs = r.join(spec, "pivot").select(own.alias("block"), *fields)
    met = lambda n: refs.join(spread(n), "block").select("block", F.explode(F.sequence(F.lit(0), F.col("_q") - 1)).alias("qb"), *fields).groupBy("block", "qb")

    homes = {b: max(1, -(-int(v) // size)) for b, v in enumerate(load)}
    asking = q.join(spec, "pivot").select(own.alias("block"), *fields).join(spread(homes), "block").select("block", part, *fields)
    names = "".join(f"{c} string, " for c in extra)
    home = materialise(
        asking.groupBy("block", "qb").cogroup(met(homes)).applyInPandas(
            lambda left, right: search.at_home(left, right) if len(left) else pd.DataFrame({c: [] for c in [*fields, "limit", "blocks", "names", "dists"]}),
            f"cell string, vec {kind}, {names}pivot int, limit double, blocks array<int>, names array<string>, dists array<double>",
        ),
        "home",
    )
    near_rows = home.select("cell", F.explode(F.arrays_zip("names", "dists")).alias("x")).select("cell", F.col("x.names").alias("neighbor"), F.col("x.dists").alias("distance"))
    away = home.select(*fields, "limit", F.explode("blocks").alias("block"))
    others = {x.block: max(1, -(-x.n // size)) for x in away.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    if others:
        asking = away.join(spread(others), "block").select("block", part, *fields, "limit")
        far = asking.groupBy("block", "qb").cogroup(met(others)).applyInPandas(lambda left, right: search.elsewhere(left, right), "cell string, neighbor string, distance double")
        near_rows = near_rows.unionByName(far)
    best = W.partitionBy("cell").orderBy("distance", "neighbor")
    # written once: graphs, votes and scales read the rows several times, and each reading would search anew
    return materialise(near_rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "near")


def knn_graph(neighbors: DataFrame, mode: str = "gaussian") -> DataFrame:
    """Symmetric weighted edges ``(src, dst, weight, distance)``, both directions stored.

    ``gaussian``: exp(-d²/σ²) with σ the distance to a cell's last neighbour, joined by
    fuzzy union.  ``jaccard``: shared neighbours over the union of both lists.
    """
    if mode == "jaccard":
        lists = neighbors.groupBy("cell").agg(F.sort_array(F.collect_list("neighbor")).alias("l"))
        pairs = neighbors.select(F.col("cell").alias("src"), F.col("neighbor").alias("dst"), "distance")
        pairs = pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "distance")).groupBy("src", "dst").agg(F.min("distance").alias("distance"))
        j = pairs.join(lists.select(F.col("cell").alias("src"), F.col("l").alias("a")), "src").join(lists.select(F.col("cell").alias("dst"), F.col("l").alias("b")), "dst")
        both = F.size(F.array_intersect("a", "b"))
        return j.select("src", "dst", (both / (F.size("a") + F.size("b") - both)).alias("weight"), "distance")
    sigma = neighbors.groupBy("cell").agg(F.max("distance").alias("_s"))
    w = neighbors.join(sigma, "cell").select(
        F.col("cell").alias("src"), F.col("neighbor").alias("dst"),
        F.when(F.col("_s") > 0, F.exp(-F.pow(F.col("distance") / F.col("_s"), F.lit(2.0)))).otherwise(1.0).alias("w"), "distance",
    )
    ends = [F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in (("src", "dst"), ("dst", "src"))]
    both = w.select(F.explode(F.array(*ends)).alias("e"), "w", "distance").select("e.src", "e.dst", "w", "distance")
    return both.groupBy("src", "dst").agg((1 - F.product(1 - F.col("w"))).alias("weight"), F.min("distance").alias("distance"))


def label_votes(neighbors: DataFrame, labels: DataFrame) -> DataFrame:
    """Votes per query cell and label."""
    return (
        neighbors.join(labels.select(F.col("cell").alias("neighbor"), "label"), "neighbor")
        .groupBy("cell", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def project_query(ref: DataFrame, query: DataFrame, labels: DataFrame, k: int = 15, exclude: str | None = None) -> DataFrame:
    """Neighbour label shares, margin, entropy, distances and out-of-distribution percentile."""
    nq = materialise(knn(query, ref, k, exclude), "nq")
    nr = nq if exclude == "cell" and query is ref else materialise(knn(ref, ref, k, "cell"), "nr")
    votes = label_votes(nq, labels)
    total = votes.groupBy("cell").agg(F.sum("n").alias("t"))
    p = F.col("n") / F.col("t")
    shares = votes.join(total, "cell").withColumn("p", p)
    order = W.partitionBy("cell").orderBy(F.col("n").desc(), "label")
    ranked = shares.withColumn("_r", F.row_number().over(order))
    top = ranked.groupBy("cell").agg(
        F.max(F.when(F.col("_r") == 1, F.col("label"))).alias("top_label"),
        F.max(F.when(F.col("_r") == 1, F.col("p"))).alias("top_label_probability"),
        F.coalesce(F.max(F.when(F.col("_r") == 2, F.col("p"))), F.lit(0.0)).alias("second_label_probability"),
        (-F.sum(F.col("p") * F.log("p"))).alias("neighbor_label_entropy"),
    )
    # written once: it is joined on a computed value below
    dist = materialise(nq.groupBy("cell").agg(F.min("distance").alias("nearest_reference_distance"), F.avg("distance").alias("mean_neighbor_distance")), "dist")
    scale = nr.groupBy("cell").agg(F.avg("distance").alias("v"))
    # reference means at or below each query mean, from one weighted ranking of both
    pooled = scale.select("v", F.lit(1).alias("w")).unionByName(dist.select(F.col("mean_neighbor_distance").alias("v"), F.lit(0).alias("w")))
    ood = value_ranks(pooled, [], "v", "w").select(F.col("v").alias("mean_neighbor_distance"), ((F.col("below") + F.col("n")) / F.col("total")).alias("ood_score"))
    return (
        top.join(dist, "cell").join(ood, "mean_neighbor_distance", "left")
        .withColumn("margin", F.col("top_label_probability") - F.col("second_label_probability"))
    )


def neighborhood_entropy(neighbors: DataFrame, labels: DataFrame) -> DataFrame:
    """Entropy of labels among a cell and its neighbours, and the effective label number."""
    own = labels.select("cell", F.col("cell").alias("neighbor"))
    votes = label_votes(neighbors.select("cell", "neighbor").unionByName(own), labels)
    total = votes.groupBy("cell").agg(F.sum("n").alias("t"))
    p = F.col("n") / F.col("t")
    out = votes.join(total, "cell").groupBy("cell").agg((-F.sum(p * F.log(p))).alias("label_entropy"))
    return out.withColumn("effective_labels", F.exp("label_entropy"))


def transfer_labels(neighbors: DataFrame, labels: DataFrame) -> DataFrame:
    """Majority label of the neighbours; ties by label name."""
    votes = label_votes(neighbors, labels)
    return votes.groupBy("cell").agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("label"), (F.max("n") / F.sum("n")).alias("share"))


def graph_cluster(edges: DataFrame, resolution: float = 1.0, seed: int = 0, max_sweeps: int | None = None, max_rounds: int | None = None) -> DataFrame:
    """``cell, cluster``: communities by modularity with a resolution parameter, numbered by size.

    No cell gains by moving and every community is connected; see ``communities``.
    """
    return communities.numbered_by_size(communities.communities(edges, resolution, seed, max_sweeps, max_rounds))


def max_jaccard(reference: DataFrame, other: DataFrame) -> DataFrame:
    """Best Jaccard of each reference cluster with a cluster of another partition, over shared cells."""
    j = reference.select("cell", F.col("cluster").alias("a")).join(other.select("cell", F.col("cluster").alias("b")), "cell")
    n = materialise(j.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "cross")
    sa, sb = n.groupBy("a").agg(F.sum("n").alias("_a")), n.groupBy("b").agg(F.sum("n").alias("_b"))
    v = n.join(sa, "a").join(sb, "b")
    return v.groupBy(F.col("a").alias("cluster")).agg(F.max(F.col("n") / (F.col("_a") + F.col("_b") - F.col("n"))).alias("jaccard"))


def stability_summary(jaccards: DataFrame, by: Sequence[str]) -> DataFrame:
    return jaccards.groupBy(*by).agg(
        F.expr("percentile(jaccard, 0.5)").alias("median"),
        F.expr("percentile(jaccard, 0.25)").alias("q25"),
        F.expr("percentile(jaccard, 0.75)").alias("q75"),
        F.count(F.lit(1)).alias("n"),
    )


def bootstrap_allocation(jaccards: DataFrame, budget: int) -> DataFrame:
    """``resolution, extra``: how many of ``budget`` further draws each resolution gets.

    Priority is the interquartile range plus the larger change of the median towards a neighbouring
    resolution, each scaled to 0..1 over the resolutions (0 where all are equal). Without any
    priority the budget is dealt evenly, without its remainder. Halves round to even.
    """
    s = stability_summary(jaccards, ["resolution"])
    order = W.partitionBy(F.lit(0)).orderBy("resolution")  # a row a resolution of the sweep
    every = W.partitionBy(F.lit(0))
    change = lambda f: F.abs(F.col("median") - f("median").over(order))
    s = s.select("resolution", (F.col("q75") - F.col("q25")).alias("_iqr"), F.coalesce(F.greatest(change(F.lag), change(F.lead)), F.lit(0.0)).alias("_step"))
    scaled = lambda c: F.when(F.max(c).over(every) > F.min(c).over(every), (F.col(c) - F.min(c).over(every)) / (F.max(c).over(every) - F.min(c).over(every))).otherwise(0.0)
    p = s.select("resolution", (scaled("_iqr") + scaled("_step")).alias("_p"))
    total, n = F.sum("_p").over(every), F.count(F.lit(1)).over(every)
    return p.select("resolution", F.when(total > 0, F.bround(F.col("_p") / total * budget, 0).cast("long")).otherwise(F.floor(F.lit(budget) / n)).alias("extra"))


def _boot_jaccards(embedding: DataFrame, refs: DataFrame, draws: dict[int, list[float]], fraction: float, k: int, seed: int) -> DataFrame:
    """``resolution, cluster, boot, jaccard``: subsamples clustered at their resolutions, all in one run, against the full clusters."""
    spark = embedding.sparkSession
    edges = None
    for b in draws:
        keep = F.pmod(F.xxhash64(F.lit(seed), F.lit(b), "cell"), F.lit(1000)) < int(1000 * fraction)
        sub = materialise(embedding.filter(keep).select("cell", "vec"), "boot")
        own = knn_graph(knn(sub, sub, k)).select(F.lit(b).alias("part"), "src", "dst", "weight")
        edges = own if edges is None else edges.unionByName(own)
    plan = spark.createDataFrame([(b, float(x)) for b, own in draws.items() for x in own], "part int, resolution double")
    found = materialise(communities.communities_of_parts(materialise(edges, "graphs"), plan, seed), "boots")
    # contingency of the full clusters with each subsample's, over the cells drawn
    pair = found.join(refs.select("resolution", "cell", F.col("cluster").alias("_ref")), ["resolution", "cell"])
    n = materialise(pair.groupBy("resolution", "part", "_ref", "cluster").agg(F.count(F.lit(1)).alias("n")), "cross")
    of = lambda c, out: n.groupBy("resolution", "part", c).agg(F.sum("n").alias(out))
    v = n.join(of("_ref", "_a"), ["resolution", "part", "_ref"]).join(of("cluster", "_b"), ["resolution", "part", "cluster"])
    return v.groupBy("resolution", F.col("_ref").alias("cluster"), F.col("part").alias("boot")).agg(F.max(F.col("n") / (F.col("_a") + F.col("_b") - F.col("n"))).alias("jaccard"))


def bootstrap_jaccards(
    embedding: DataFrame, resolutions: Sequence[float], n_boot: int = 20, fraction: float = 0.8, k: int = 15, seed: int = 0,
    adaptive: bool = True, initial: float = 0.3,
) -> DataFrame:
    """``resolution, cluster, boot, jaccard``: how well subsamples recover each cluster of the full data.

    Adaptive: a first round draws ``initial`` of the subsamples for every resolution; what is left of the
    budget goes where the first round was uncertain or stability changes (``bootstrap_allocation``).
    Subsamples are hashed, so draw b is the same for every resolution. Clusters of which no cell is
    drawn have no row.
    """
    sweep = [float(x) for x in resolutions]
    full = knn_graph(knn(embedding, embedding, k)).select(F.lit(-1).alias("part"), "src", "dst", "weight")
    plan = embedding.sparkSession.createDataFrame([(-1, x) for x in sweep], "part int, resolution double")
    refs = materialise(communities.communities_of_parts(materialise(full, "graph"), plan, seed), "clusters")
    first = min(n_boot, max(1, round(n_boot * initial))) if adaptive else n_boot
    rows = materialise(_boot_jaccards(embedding, refs, {b: sweep for b in range(first)}, fraction, k, seed), "jaccards")
    if n_boot > first:
        extra = {r.resolution: r.extra for r in bootstrap_allocation(rows, (n_boot - first) * len(sweep)).collect()}
        draws = {first + b: [x for x in sweep if extra[x] > b] for b in range(max(extra.values()))}
        if draws:
            rows = rows.unionByName(materialise(_boot_jaccards(embedding, refs, draws, fraction, k, seed), "jaccards"))
    return rows


def resolution_stability(
    embedding: DataFrame, resolutions: Sequence[float], n_boot: int = 20, fraction: float = 0.8, k: int = 15, seed: int = 0,
    adaptive: bool = True, initial: float = 0.3,
) -> DataFrame:
    """Median, quartiles and number of the recovered Jaccards of each cluster and resolution."""
    return stability_summary(bootstrap_jaccards(embedding, resolutions, n_boot, fraction, k, seed, adaptive, initial), ["resolution", "cluster"])


def donor_gate(
    cells: DataFrame, cluster: str, donor: str, lodo: DataFrame | None = None,
    min_groups: int = 3, min_cells: int = 10, max_frac: float = 0.8, min_agreement: float = 0.5,
) -> DataFrame:
    """Donor support of each cluster and, when given, leave-one-donor-out agreement."""
    n = cells.groupBy(cluster, donor).agg(F.count(F.lit(1)).alias("n"))
    out = n.groupBy(cluster).agg(
        F.sum("n").alias("n_cells"), F.count(F.lit(1)).alias("n_groups"),
        F.count_if(F.col("n") >= min_cells).alias("n_supporting"), (F.max("n") / F.sum("n")).alias("max_group_frac"),
    )
    tests = [
        (F.col("n_supporting") < min_groups, f"fewer_than_{min_groups}_supporting_groups"),
        (F.col("max_group_frac") > max_frac, "dominated_by_one_group"),
    ]
    if lodo is not None:
        agree = cells.select("cell", cluster).join(lodo.select("cell", "label"), "cell").groupBy(cluster).agg(
            F.avg((F.col(cluster) == F.col("label")).cast("double")).alias("lodo_agreement")
        )
        out = out.join(agree, cluster, "left")
        tests.append((F.coalesce(F.col("lodo_agreement") < min_agreement, F.lit(True)), "low_lodo_agreement"))
    reason = F.lit("")
    for failed, text in reversed(tests):
        reason = F.when(failed, text).otherwise(reason)
    return out.withColumn("reason", reason).withColumn("passed", F.col("reason") == "")


def leave_one_donor_out(embedding: DataFrame, cells: DataFrame, cluster: str, donor: str, k: int = 15) -> DataFrame:
    """Majority cluster of each cell's neighbours from other donors."""
    e = materialise(embedding.join(cells.select("cell", F.col(donor).cast("string").alias("donor")), "cell").select("cell", "vec", "donor"), "lodo")
    return transfer_labels(knn(e, e, k, "donor"), cells.select("cell", F.col(cluster).alias("label")))


def qc_consistency(
    cells: DataFrame, cluster: str, metrics: dict[str, str], rates: Sequence[str] = (), z_bar: float = 2.5,
    min_mads: float = 1.5, min_rate: float = 0.02,
) -> DataFrame:
    """Clusters whose metric medians or flag rates stand apart from the population.

    ``metrics`` maps a column to ``high_is_bad``, ``low_is_bad`` or ``both``.
    """
    pairs = [F.struct(F.lit(m).alias("metric"), F.lit(d).alias("direction"), F.col(m).cast("double").alias("x")) for m, d in metrics.items()]
    long = materialise(cells.select(cluster, F.explode(F.array(*pairs)).alias("p")).select(cluster, "p.metric", "p.direction", "p.x").filter(F.col("x").isNotNull()), "long")
    pop = materialise(grouped_quantiles(long, ["metric"], "x", {"population": 0.5}).drop("n_values"), "pop")
    dev = long.join(pop, "metric").withColumn("d", F.abs(F.col("x") - F.col("population")))
    mad = grouped_quantiles(dev, ["metric"], "d", {"mad": 0.5}).drop("n_values")
    med = grouped_quantiles(long, [cluster, "metric"], "x", {"cluster_value": 0.5})
    sigma = F.greatest(1.4826 * F.col("mad"), F.lit(1e-9))
    out = med.join(pop, "metric").join(mad, "metric").withColumn(
        "z", (F.col("cluster_value") - F.col("population")) / (1.2533 * sigma / F.sqrt("n_values"))
    ).withColumn("effect", (F.col("cluster_value") - F.col("population")) / sigma)
    sign = F.lit(0)
    for m, d in metrics.items():
        sign = F.when(F.col("metric") == m, {"high_is_bad": 1, "low_is_bad": -1}.get(d, 0)).otherwise(sign)
    out = out.withColumn("_s", sign)
    zz = F.when(F.col("_s") == 0, F.abs("z")).otherwise(F.col("z") * F.col("_s"))
    ee = F.when(F.col("_s") == 0, F.abs("effect")).otherwise(F.col("effect") * F.col("_s"))
    table = out.select(cluster, "metric", F.col("n_values").alias("n_cells"), "cluster_value", "population", "z", "effect", ((zz > z_bar) & (ee >= min_mads)).alias("flagged"))
    if rates:
        rp = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in rates]
        rl = cells.select(cluster, F.explode(F.array(*rp)).alias("p")).select(cluster, "p.metric", "p.x")
        p0 = rl.groupBy("metric").agg(F.avg("x").alias("population"))
        rc = rl.groupBy(cluster, "metric").agg(F.avg("x").alias("cluster_value"), F.count("x").alias("n_cells")).join(p0, "metric")
        se = F.sqrt(F.greatest(F.col("population") * (1 - F.col("population")), F.lit(1e-12)) / F.col("n_cells"))
        diff = F.col("cluster_value") - F.col("population")
        table = table.unionByName(
            rc.select(cluster, "metric", "n_cells", "cluster_value", "population", (diff / se).alias("z"), diff.alias("effect"), ((diff / se > z_bar) & (diff >= min_rate)).alias("flagged"))
        )
    return table


def group_connectivity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Observed over expected edge weight between groups of the graph."""
    e = edges.join(labels.select(F.col("cell").alias("src"), F.col("label").alias("group_a")), "src").join(
        labels.select(F.col("cell").alias("dst"), F.col("label").alias("group_b")), "dst"
    )
    obs = materialise(e.groupBy("group_a", "group_b").agg(F.sum("weight").alias("observed")), "groups")
    deg = obs.groupBy("group_a").agg(F.sum("observed").alias("k"))
    total = obs.agg(F.sum("observed").alias("m"))
    j = obs.join(deg, "group_a").join(deg.select(F.col("group_a").alias("group_b"), F.col("k").alias("kb")), "group_b")
    return attach(j, total, []).filter(F.col("group_a") < F.col("group_b")).select(
        "group_a", "group_b", "observed", (F.col("observed") * F.col("m") / (F.col("k") * F.col("kb"))).alias("connectivity")
    )


def cluster_markers(layer: DataFrame, cells: DataFrame, cluster: str, n_top: int | None = None) -> DataFrame:
    """Rank-sum z of each gene, cluster against rest, zeros ranked below every positive value.

    Positive values are ranked per gene from their distinct values; the zeros of a gene
    are one tied block whose rank and tie term are closed forms of their number.
    """
    pos = materialise(layer.filter(F.col("value") > 0), "positive")  # joined on its values below
    ranks = materialise(value_ranks(pos, ["gene"], "value"), "ranks")
    n = cells.agg(F.count(F.lit(1)).cast("double").alias("N"))
    sizes = cells.groupBy(cluster).agg(F.count(F.lit(1)).cast("double").alias("n1"))
    ties = ranks.groupBy("gene").agg(F.sum(F.pow("n", F.lit(3.0)) - F.col("n")).alias("_t"), F.max("total").alias("_pos"))
    r = (
        pos.join(cells.select("cell", cluster), "cell")
        .groupBy("gene", cluster, "value").agg(F.count(F.lit(1)).alias("m"), F.sum("value").alias("s"))
        .join(ranks, ["gene", "value"])
        .groupBy("gene", cluster)
        .agg(F.sum(F.col("m") * (F.col("below") + (F.col("n") + 1) / 2.0)).alias("_r"), F.sum("m").alias("_k"), F.sum("s").alias("_sum"))
    )
    grid = attach(with_levels(ties, cluster, bounded_levels(cells, cluster)).join(sizes, cluster), n, []).join(r, ["gene", cluster], "left").fillna(0, ["_r", "_k", "_sum"])
    zeros = F.col("N") - F.col("_pos")
    rank_sum = F.col("_r") + F.col("_k") * zeros + (F.col("n1") - F.col("_k")) * (zeros + 1) / 2
    n1, n2 = F.col("n1"), F.col("N") - F.col("n1")
    tie = F.col("_t") + F.pow(zeros, F.lit(3.0)) - zeros
    sd = F.sqrt(n1 * n2 / 12 * ((F.col("N") + 1) - tie / (F.col("N") * (F.col("N") - 1))))
    out = grid.select("gene", cluster, ((rank_sum - n1 * (F.col("N") + 1) / 2) / F.nullif(sd, F.lit(0.0))).alias("score"), (F.col("_sum") / n1).alias("mean"), (F.col("_k") / n1).alias("fraction"))
    if n_top is None:
        return out
    order = W.partitionBy(cluster).orderBy(F.col("score").desc(), "gene")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_top)


def _walk(edges: DataFrame, self_weight: float) -> DataFrame:
    """``src, dst, p``: the row-normalised graph with self loops, written once."""
    e = materialise(edges.select("src", "dst", "weight"), "graph")  # joined with its own sums
    loops = e.select(F.col("src").alias("n")).distinct().select(F.col("n").alias("src"), F.col("n").alias("dst"), F.lit(self_weight).alias("weight"))
    all_e = e.unionByName(loops)
    norm = all_e.groupBy("src").agg(F.sum("weight").alias("_w"))
    return materialise(all_e.join(norm, "src").select("src", "dst", (F.col("weight") / F.col("_w")).alias("p")), "walk")


def _diffuse(walk: DataFrame, layer: DataFrame) -> DataFrame:
    """One diffusion step; every step is written, for the next ones read it."""
    sums = walk.join(layer.withColumnRenamed("cell", "dst"), "dst").groupBy(F.col("src").alias("cell"), "gene").agg(F.sum(F.col("p") * F.col("value")).alias("value"))
    return materialise(sums, "smooth")


def graph_smooth(edges: DataFrame, layer: DataFrame, t: int = 1, self_weight: float = 1.0) -> DataFrame:
    """t diffusion steps of gene values over the row-normalised graph with self loops."""
    p = _walk(edges, self_weight)
    out = layer.select("cell", "gene", "value")
    for _ in range(t):
        out = _diffuse(p, out)
    return out


def refine_labels(edges: DataFrame, layer: DataFrame, groups: DataFrame, cells: DataFrame, bars: dict[str, float], margin: float = 0.0) -> DataFrame:
    """Split a broad label by neighbourhood evidence of marker groups.

    Evidence is the mean of the one-step and two-step neighbour averages of a group's
    mean expression; the strongest group over its bar wins by ``margin`` or the cell
    stays Unassigned with the reason.
    """
    size = groups.groupBy("source").agg(F.count(F.lit(1)).alias("_k"))
    per = layer.join(groups.select("source", F.col("target").alias("gene")), "gene").groupBy("cell", "source").agg(F.sum("value").alias("s")).join(size, "source").select(
        "cell", F.col("source").alias("gene"), (F.col("s") / F.col("_k")).alias("value")
    )
    walk = _walk(edges, 0.0)
    one = _diffuse(walk, per)
    two = _diffuse(walk, one)
    ev = one.unionByName(two).groupBy("cell", "gene").agg((F.sum("value") / 2).alias("e"))
    names = sorted(bars)
    wide = cells.select("cell").join(ev.groupBy("cell").pivot("gene", names).agg(F.first("e")), "cell", "left").fillna(0.0)
    ranked = F.sort_array(F.array(*[F.struct(F.col(f"`{g}`").alias("e"), F.lit(g).alias("g"), F.lit(bars[g]).alias("bar")) for g in names]), asc=False)
    out = wide.withColumn("_r", ranked)
    top, second = F.col("_r")[0], F.col("_r")[1]
    weak, close = top["e"] < top["bar"], (top["e"] - second["e"]) < margin
    return out.select(
        "cell", *[F.col(f"`{g}`") for g in names],
        F.when(weak | close, "Unassigned").otherwise(top["g"]).alias("call"),
        F.when(weak, "weak_evidence").when(close, "close_call").otherwise("").alias("reason"),
    )


def map_reference(votes_by_seed: DataFrame, hierarchy: DataFrame | None = None) -> DataFrame:
    """Soft labels averaged over seeds, with entropy, agreement and the coarse parent.

    ``votes_by_seed`` is ``(seed, cell, label, n)``.  A fine label with several parents
    has none.
    """
    total = votes_by_seed.groupBy("seed", "cell").agg(F.sum("n").alias("t"))
    p = votes_by_seed.join(total, ["seed", "cell"]).withColumn("p", F.col("n") / F.col("t"))
    seeds = votes_by_seed.agg(F.count_distinct("seed").alias("_s"))
    soft = materialise(attach(p.groupBy("cell", "label").agg(F.sum("p").alias("_p")), seeds, []).select("cell", "label", (F.col("_p") / F.col("_s")).alias("prob")), "soft")
    top = soft.groupBy("cell").agg(
        F.min_by("label", F.struct(-F.col("prob"), F.col("label"))).alias("label"), F.max("prob").alias("prob"), (-F.sum(F.col("prob") * F.log("prob"))).alias("entropy")
    )
    each = p.groupBy("seed", "cell").agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("_l"))
    agree = attach(each.join(top, "cell").groupBy("cell").agg(F.count_if(F.col("_l") == F.col("label")).alias("_a")), seeds, []).select("cell", (F.col("_a") / F.col("_s")).alias("consensus_fraction"))
    out = top.join(agree, "cell")
    if hierarchy is not None:
        parents = hierarchy.groupBy("label").agg(F.min("parent").alias("coarse"), F.count_distinct("parent").alias("_n")).filter(F.col("_n") == 1).drop("_n")
        out = out.join(parents, "label", "left")
    return out


def metacell_summary(assignments: DataFrame, metacell: str, group: str) -> DataFrame:
    """Dominant group, purity and size of each metacell; ties by group name."""
    n = assignments.filter(F.col(metacell).isNotNull()).groupBy(metacell, group).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(metacell).agg(
        F.min_by(group, F.struct(-F.col("n"), F.col(group))).alias("dominant"), (F.max("n") / F.sum("n")).alias("purity"), F.sum("n").alias("size")
    )


def metacell_overview(assignments: DataFrame, metacell: str, group: str) -> DataFrame:
    s = metacell_summary(assignments, metacell, group)
    out = s.agg(F.count(F.lit(1)).alias("n_metacells"), F.expr("percentile(size, 0.5)").alias("median_size"), F.avg("purity").alias("mean_purity"))
    loose = assignments.agg(F.avg(F.col(metacell).isNull().cast("double")).alias("outlier_share"))
    return attach(out, loose, [])


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable name of each node, by neighbour minima and pointer jumps until none changes.

    Tables of a row a node are joined by shuffles: broadcasts of every round would pile up in the driver.
    When the edges between different names fit one task, they are followed to their end there.
    """
    ends = [F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in (("src", "dst"), ("dst", "src"))]
    e = materialise(edges.select(F.explode(F.array(*ends)).alias("e")).select("e.src", "e.dst").distinct(), "edges")
    state = e.select(F.col("src").alias("node")).distinct().withColumn("c", F.col("node"))
    while True:
        low = e.hint("merge").join(state.select(F.col("node").alias("dst"), "c").hint("merge"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("c").alias("_m"))
        # written once, for the jump reads it a second time
        step = materialise(state.hint("merge").join(low.hint("merge"), "node", "left").select("node", F.col("c").alias("_o"), F.least("c", "_m").alias("c")), "low")
        jump = step.select(F.col("node").alias("c"), F.col("c").alias("_j"))
        new = materialise(step.hint("merge").join(jump.hint("merge"), "c", "left").select("node", "_o", F.least("c", "_j").alias("c")), "components")
        state = new.select("node", "c")
        if new.filter(F.col("c") != F.col("_o")).isEmpty():
            return state
        if e.schema["src"].dataType.simpleString() != "string":
            continue
        of = lambda side: state.select(F.col("node").alias(side), F.col("c").alias(f"c_{side}")).hint("merge")
        apart = e.hint("merge").join(of("src"), "src").hint("merge").join(of("dst"), "dst").filter(F.col("c_src") != F.col("c_dst"))
        apart = materialise(apart.select(F.col("c_src").alias("src"), F.col("c_dst").alias("dst")).distinct(), "apart")
        if small_graphs.fits(apart):
            up = small_graphs.least_linked(apart).select(F.col("node").alias("c"), F.col("c").alias("_up"))
            return materialise(state.hint("merge").join(up.hint("merge"), "c", "left").select("node", F.coalesce("_up", "c").alias("c")), "components")


def lisi(neighbors: DataFrame, labels: DataFrame) -> DataFrame:
    """Inverse Simpson index of neighbour labels per cell."""
    v = label_votes(neighbors, labels)
    t = v.groupBy("cell").agg(F.sum("n").alias("t"))
    p = F.col("n") / F.col("t")
    return v.join(t, "cell").groupBy("cell").agg((1 / F.sum(p * p)).alias("lisi"))


def batch_rejection(neighbors: DataFrame, batch: DataFrame) -> DataFrame:
    """χ² of each neighbourhood's batch counts against the global batch shares."""
    share = attach(batch.groupBy("label").agg(F.count(F.lit(1)).alias("g")), batch.agg(F.count(F.lit(1)).alias("N")), [])
    v = label_votes(neighbors, batch)
    t = v.groupBy("cell").agg(F.sum("n").alias("t"))
    s = materialise(share.select("label", (F.col("g") / F.col("N")).alias("f")), "shares")
    k = s.count()
    # Σ (o-e)²/e = Σ o²/e - t, so batches absent from a neighbourhood need no row
    return v.join(s, "label").join(t, "cell").groupBy("cell", "t").agg(F.sum(F.col("n") * F.col("n") / (F.col("t") * F.col("f"))).alias("_q")).select(
        "cell", (F.col("_q") - F.col("t")).alias("chi2"), F.lit(float(k - 1)).alias("df")
    )


def pc_regression(embedding: DataFrame, batch: DataFrame) -> DataFrame:
    """Share of embedding variance explained by batch, weighted over dimensions."""
    long = embedding.select("cell", "vec").join(batch.select("cell", "label"), "cell").select("label", F.posexplode("vec").alias("dim", "x"))
    b = long.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("double")).alias("s"), F.sum(F.col("x").cast("double") * F.col("x")).alias("ss"))
    d = b.groupBy("dim").agg(
        (F.sum("ss") - F.sum("s") * F.sum("s") / F.sum("n")).alias("tot"),
        (F.sum(F.col("s") * F.col("s") / F.col("n")) - F.sum("s") * F.sum("s") / F.sum("n")).alias("between"),
    )
    return d.agg((F.sum("between") / F.sum("tot")).alias("pcr"))


def silhouette(embedding: DataFrame, labels: DataFrame) -> float:
    """Mean silhouette of labels on squared distances, from per-label sums."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    ids = {v: float(i) for i, v in enumerate(bounded_levels(labels, "label"))}
    code = F.create_map(*[F.lit(x) for kv in ids.items() for x in kv])
    data = embedding.select("cell", "vec").join(labels.select("cell", "label"), "cell").select(
        array_to_vector(F.col("vec").cast("array<double>")).alias("features"), F.element_at(code, F.col("label")).alias("prediction")
    )
    return float(ClusteringEvaluator().evaluate(data))


def integration_metrics(
    embeddings: dict[str, DataFrame], batch: DataFrame, label: DataFrame, k: int = 15, alpha: float = 0.05, resolution: float = 1.0
) -> DataFrame:
    """Mixing and conservation scores of each embedding and their weighted rank.

    The neighbour graphs of all embeddings are clustered side by side, in one run of the loop.
    """
    from ..functions import tails
    from . import integration as g

    n_b, n_l = batch.select("label").distinct().count(), label.select("label").distinct().count()
    near = {name: materialise(knn(emb, emb, k), "nb") for name, emb in embeddings.items()}
    graphs = {name: materialise(knn_graph(nb), "graph") for name, nb in near.items()}
    sides = None
    for name, graph in graphs.items():
        own = graph.select(F.lit(name).alias("part"), "src", "dst", "weight")
        sides = own if sides is None else sides.unionByName(own)
    plan = batch.sparkSession.createDataFrame([(name, float(resolution)) for name in embeddings], "part string, resolution double")
    agreed = materialise(g.cluster_agreement(communities.communities_of_parts(sides, plan), label, ("part",)), "agreed")
    rows = None
    for name, emb in embeddings.items():
        nb = near[name]
        parts = [
            lisi(nb, batch).agg(((F.avg("lisi") - 1) / max(n_b - 1, 1)).alias("ilisi")),
            lisi(nb, label).agg((1 - (F.avg("lisi") - 1) / max(n_l - 1, 1)).alias("clisi")),
            batch_rejection(nb, batch).agg((1 - F.avg((tails.chi2_sf("chi2", "df") < alpha).cast("double"))).alias("kbet")),
            pc_regression(emb, batch),
            g.graph_connectivity(graphs[name], label).agg(F.avg("connectivity").alias("graph_connectivity")),
            g.batch_silhouette(emb, label, batch).agg(F.avg("score").alias("batch_silhouette")),
            agreed.filter(F.col("part") == name).select("nmi", "ari"),
            transfer_labels(nb, label).select("cell", F.col("label").alias("_l")).join(label.select("cell", F.col("label").alias("_t")), "cell").agg(F.avg((F.col("_l") == F.col("_t")).cast("double")).alias("label_agreement")),
        ]
        row = parts[0]
        for more in parts[1:]:
            row = attach(row, more, [])
        row = row.withColumns({"embedding": F.lit(name), "label_silhouette": F.lit((silhouette(emb, label) + 1) / 2)})
        rows = row if rows is None else rows.unionByName(row)
    mean = lambda *c: sum((F.coalesce(x, F.lit(0.0)) for x in c), F.lit(0.0)) / len(c)
    mixing = mean(F.col("ilisi"), F.col("kbet"), 1 - F.col("pcr"), F.col("graph_connectivity"), F.col("batch_silhouette"))
    kept = mean(F.col("clisi"), F.col("label_agreement"), F.col("label_silhouette"), F.col("nmi"), F.col("ari"))
    rows = materialise(rows, "metrics")
    return rows.withColumn("total", 0.4 * mixing + 0.6 * kept).withColumn("rank", F.rank().over(W.partitionBy(F.lit(0)).orderBy(F.col("total").desc())))


def neighbourhood_counts(neighbors: DataFrame, cells: DataFrame, sample: Sequence[str], prop: float = 0.1, seed: int = 0) -> DataFrame:
    """Cells of each sample in the neighbourhoods of a hashed share of index cells."""
    pick = F.pmod(F.xxhash64(F.lit(seed), "cell"), F.lit(10_000)) < int(10_000 * prop)
    index = neighbors.filter(pick).select(F.col("cell").alias("nhood"), F.col("neighbor").alias("cell"))
    own = index.select("nhood").distinct().withColumn("cell", F.col("nhood"))
    return index.unionByName(own).join(cells.select("cell", *sample), "cell").groupBy("nhood", *sample).agg(F.count(F.lit(1)).alias("n"))


def neighbourhood_da(
    neighbors: DataFrame, cells: DataFrame, donor: str, condition: str, cell_type: str, case: str, control: str, prop: float = 0.1, seed: int = 0
) -> DataFrame:
    """Log-CPM contrast of every neighbourhood over samples, with a distance-weighted FDR.

    Samples absent from a neighbourhood are zero counts, entered as constants of the
    sample as in the pseudobulk contrast.
    """
    from .compare import pseudobulk_de

    counts = neighbourhood_counts(neighbors, cells.filter(F.col(condition).isin(case, control)), [donor, condition], prop, seed)
    pb = counts.select(F.col("nhood").alias("gene"), donor, condition, F.col("n").alias("count"))
    de = pseudobulk_de(pb, donor, condition, case, control, min_count=0, min_total=1, paired=False).drop("fdr")
    from ..functions.fdr import bh_fdr

    far = neighbors.groupBy(F.col("cell").alias("gene")).agg((1 / F.greatest(F.max("distance"), F.lit(1e-12))).alias("_w"))
    out = bh_fdr(de.join(far, "gene"), "p", out="spatial_fdr", weight="_w").drop("_w")
    index = neighbors.select(F.col("cell").alias("gene"), F.col("neighbor").alias("cell")).join(cells.select("cell", cell_type), "cell")
    n = index.groupBy("gene", cell_type).agg(F.count(F.lit(1)).alias("n")).groupBy("gene").agg(
        F.min_by(cell_type, F.struct(-F.col("n"), F.col(cell_type))).alias("dominant_type"), (F.max("n") / F.sum("n")).alias("dominant_share")
    )
    return out.join(n, "gene", "left").withColumnRenamed("gene", "nhood")
