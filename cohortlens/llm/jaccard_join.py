"""N-gram Jaccard self-join: prefix filters under several global token orders, then exact checks."""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialise

from .common import connected_components, discard, free_shuffles, release_memory

#: Token orders: runs of neighbours under the first give candidates, a pair must also share prefix tokens under the others.
ORDERS = 3
#: Frequent shingles that the orders put last, at most; a shingle counts as one from this number on.
MAX_FREQUENT, FREQUENT = 200_000, 8
#: Shingles a task counts at once, and members of a token's group that are all compared with each other.
COUNT_AT_ONCE, SMALL_GROUP = 1_000_000, 24
#: Slices in which the keys of all sets are shuffled, one after the other: what lies on disk at once is one slice's.
SLICES = 4
#: Words whose hashes a task remembers.
MAX_KNOWN = 200_000
#: Tokens, or runs of neighbours, that linked sets share in their prefixes, at least (fewer if they share fewer
#: at all), and ids that are broadcast, at most; more of them are joined by a shuffle.
COMMON, MAX_BROADCAST = 6, 1_000_000
#: Sets from this size on share ``COMMON`` runs with what they link to, smaller ones at least one.
LONG = 64
#: Longest bitmap of a set, and the short one that goes with each row of a group, in words of 64 bits.
MAX_WORDS, SHORT = 256, [f"x{k}" for k in range(8)]

_C = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text, size: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct word shingles; ``known`` keeps word hashes."""
    # white space of bytes is x20 and x09-x0D, and their lower() touches A-Z only
    words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > MAX_KNOWN:
        known.clear()
    for w in {w for w in words if w not in known}:
        known[w] = xxhash.xxh64_intdigest(w)
    h = np.array([known[w] for w in words], dtype=np.uint64)
    k = min(size, len(h))
    out = h[: len(h) - k + 1].copy()
    for i in range(1, k):
        out = out * _C + h[i : len(h) - k + 1 + i]
    return np.unique(_mix(out + np.uint64(k)))


def _ranks(tokens: np.ndarray, order: int, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Places in one global order: frequency class, then a hash seeded with the order."""
    values, classes = frequent
    rank = _mix(tokens ^ np.uint64((order + 1) * 0x6B747F5C332CFEC9 % 2**64)) >> np.uint64(6)
    if len(values):
        at = np.minimum(np.searchsorted(values, tokens), len(values) - 1)
        rank |= np.where(values[at] == tokens, classes[at], 0).astype(np.uint64) << np.uint64(58)
    return rank


def prefix(tokens: np.ndarray, order: int, n_prefix: int, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first tokens in one global order."""
    if n_prefix >= len(tokens):
        return tokens
    return tokens[np.argpartition(_ranks(tokens, order, frequent), n_prefix - 1)[:n_prefix]]


def most_different(n: int, num: int, den: int) -> int:
    """Tokens in one only of a set of n and a set it links to, at most."""
    return (n + n * den // num) * (den - num) // (den + num)


def has_runs(num: int, den: int) -> bool:
    """Whether linked unequal sets of any size share two neighbours of the order, and long ones ``COMMON`` times."""
    spare = lambda n: -(-num * n // den) - 1 - most_different(n, num, den)
    # from there on the share of common tokens alone decides
    return 4 * num >= 3 * den and all(
        most_different(n, num, den) == 0 or spare(n) >= (COMMON if n >= num * LONG // den else 1) for n in range(1, 8 * LONG)
    )


def keys(tokens: np.ndarray, num: int, den: int, runs: bool, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Hashes of the pairs of neighbours in a set's prefix under the first order; linked unequal sets share some.

    A token of one set only parts at most one pair of neighbours among the common tokens. So of
    the first d + 1 + c common ones at least c pairs are neighbours in both sets, for d such tokens.
    Where that leaves nothing (low likeness, not ``runs``), the prefix tokens themselves are the keys.
    """
    n = len(tokens)
    if not runs:
        return prefix(tokens, 0, prefix_length(n, num, den), frequent)
    d = most_different(n, num, den)
    if d == 0:  # links to equal sets only
        return tokens[:0]
    m = min(n, n - -(-num * n // den) + d + 1 + COMMON)
    rank = _ranks(tokens, 0, frequent)
    at = np.argpartition(rank, m - 1)[:m] if m < n else np.arange(n)
    first = tokens[at[np.lexsort((tokens[at], rank[at]))]]
    return _mix(first[:-1] * _C + first[1:])


def bitmap(tokens: np.ndarray, words: int | None = None) -> np.ndarray:
    """Parity of the tokens on each of twice as many bits: two sets' bitmaps differ in no more bits than the sets in tokens."""
    if words is None:
        words = 4
        while words < MAX_WORDS and words * 32 < len(tokens):
            words *= 2
    at = (_mix(tokens ^ _C) & np.uint64(words * 64 - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=words * 64) & 1).astype(np.uint8), bitorder="little").view(np.int64)


def prefix_length(n: int, num: int, den: int) -> int:
    """A set of n shares ``min(COMMON, least overlap)`` tokens of its prefix with every set it links to."""
    least = -(-num * n // den)
    return n - least + min(COMMON, least)


def frequent_shingles(docs: DataFrame, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur often, with the logarithm of their count; they only set the token orders.

    Every text is counted, in runs of ``COUNT_AT_ONCE`` shingles, each distinct set once a run; a
    run hands on what it has met twice. So counts are lower bounds, any of which gives a valid order.
    """

    def count(batches):
        known: dict[bytes, int] = {}
        parts, seen, total = [], set(), 0

        def flush():
            values, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64),) * 2
            return pd.DataFrame({"h": values[n > 1].view(np.int64), "n": n[n > 1].astype(np.int64)})

        for pdf in batches:
            for t in pdf[text]:
                s = shingle_set(t, size, known)
                mark = hashlib.blake2b(s.tobytes(), digest_size=8).digest()
                if mark in seen:
                    continue
                seen.add(mark)
                parts.append(s)
                total += len(s)
                if total >= COUNT_AT_ONCE:
                    yield flush()
                    parts, seen, total = [], set(), 0
        yield flush()
        parts, known = [], {}
        release_memory()

    per = docs.select(text).mapInPandas(count, "h long, n long")
    top = (
        per.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "h").limit(MAX_FREQUENT).toPandas()
    )
    values = top.h.to_numpy(dtype=np.int64).view(np.uint64)
    by = np.argsort(values)
    return values[by], np.log2(top.n.to_numpy(dtype=float)).astype(np.int64)[by] if len(top) else np.zeros(0, np.int64)


def _signatures(docs: DataFrame, id: str, text: str, size: int, num: int, den: int, shared) -> DataFrame:
    """``row, doc, n, same (digest of the set), t0 ... (keys in the first order, by slice)`` of every row."""
    runs = has_runs(num, den)
    slices = [f"t{k}" for k in range(SLICES)]

    def run(batches):
        known: dict[bytes, int] = {}
        for pdf in batches:
            out = []
            for t in pdf[text]:
                s = shingle_set(t, size, known)
                p = keys(s, num, den, runs, shared.value) if len(s) else s
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                out.append((len(s), digest, *[p[p % np.uint64(SLICES) == k].view(np.int64) for k in range(SLICES)]))
            n, same, *tokens = zip(*out) if out else [()] * (SLICES + 2)
            yield pd.DataFrame({"doc": pdf[id], "n": n, "same": same} | dict(zip(slices, tokens)))
        known.clear()
        release_memory()

    kind = docs.schema[id].dataType.simpleString()
    out = docs.select(id, text).mapInPandas(run, f"doc {kind}, n long, same binary, " + ", ".join(f"{t} array<long>" for t in slices))
    return out.withColumn("row", F.monotonically_increasing_id())


def _profiles(docs: DataFrame, text: str, size: int, num: int, den: int, shared) -> DataFrame:
    """``node, n, bits (bitmap), x0 ... (short one), tokens (set), filters (prefix in each further order)`` of the given documents."""

    def run(batches):
        known: dict[bytes, int] = {}
        for pdf in batches:
            out = []
            for t in pdf["_text"]:
                s = shingle_set(t, size, known)
                m = prefix_length(len(s), num, den) if len(s) else 0
                filters = [prefix(s, k, m, shared.value).view(np.int64) for k in range(1, ORDERS)]
                out.append((s.view(np.int64), *filters, bitmap(s), bitmap(s, len(SHORT))))
            columns = list(zip(*out)) if out else [()] * (ORDERS + 2)
            short = np.array(columns[-1], dtype=np.int64).reshape(-1, len(SHORT))
            yield pd.DataFrame({"node": pdf["node"], "n": [len(s) for s in columns[0]], "bits": columns[-2], "tokens": columns[0]} | {f"f{k}": columns[k] for k in range(1, ORDERS)} | dict(zip(SHORT, short.T)))
        known.clear()
        release_memory()

    schema = "node long, n long, bits array<long>, tokens array<long>, " + ", ".join([f"f{k} array<long>" for k in range(1, ORDERS)] + [f"{x} long" for x in SHORT])
    return docs.select("node", "_text").mapInPandas(run, schema)


def _bits_apart(x, y):
    """Bits in which two bitmaps differ, the longer one folded once; null if they are of unlike lengths then."""
    half = lambda v: (F.size(v) / 2).cast("int")
    fold = lambda v: F.zip_with(F.slice(v, 1, half(v)), F.slice(v, half(v) + 1, half(v)), lambda p, q: p.bitwiseXOR(q))
    short = lambda v, w: F.when(F.size(v) > F.size(w), fold(v)).otherwise(v)
    apart = F.zip_with(short(x, y), short(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(apart, F.lit(0), lambda total, one: total + one)


def _verified(pairs: DataFrame, profiles: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``a, b`` whose bitmaps are near enough, that pass the filters of the further orders, and then the exact test.

    Linked sets share ``COMMON`` tokens of their prefixes under every order, or all that they share at least.
    """
    light = lambda side: profiles.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("bits").alias(f"b{side}"))
    near = pairs.join(light("a"), "a").join(light("b"), "b")
    apart = F.coalesce(_bits_apart(F.col("ba"), F.col("bb")), F.lit(0))
    kept = materialise(near.filter(apart * (den + num) <= (F.col("na") + F.col("nb")) * (den - num)).select("a", "b").distinct(), "kept")
    asked = kept.select(F.col("a").alias("node")).union(kept.select("b")).distinct()
    asked = profiles.drop("bits", *SHORT).join(asked, "node", "left_semi")
    full = lambda side: asked.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("tokens").alias(f"t{side}"), *[F.col(f"f{k}").alias(f"{side}{k}") for k in range(1, ORDERS)])
    whole = kept.join(full("a"), "a").join(full("b"), "b")
    least = F.least(F.lit(COMMON), *[F.ceil(F.col(f"n{side}") * num / den) for side in "ab"])
    for k in range(1, ORDERS):
        whole = whole.filter(F.size(F.array_intersect(f"a{k}", f"b{k}")) >= least)
    # whole sets are intersected where they are joined: batches of them for Python workers have no bound in bytes
    whole = whole.select("a", "b", F.size(F.array_intersect("ta", "tb")).alias("_both"), (F.size("ta") + F.size("tb")).alias("_sum"))
    union = F.col("_sum") - F.col("_both")
    found = materialise(whole.filter(F.col("_both") * den >= union * num).select("a", "b"), "links")
    discard(kept)
    return found


def _groups(rows: DataFrame, num: int, den: int) -> DataFrame:
    """``token, node, n, weight (keys the node shares)``: of groups with the same nodes one stays.

    ``rows`` are signatures of one row for each set. Nodes with fewer shared keys than any link needs are left out.
    """
    slices = []
    for k in range(SLICES):
        # dealt by key once, for the counts and for the rows alike
        dealt = rows.select(F.explode(f"t{k}").alias("token"), F.col("doc").alias("node"), "n").repartition("token")
        often = dealt.groupBy("token").agg(
            F.count(F.lit(1)).alias("m"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.min("n").alias("s"), F.max("n").alias("l")
        )
        often = often.filter("lo <> hi").filter((F.col("m") > 2) | (F.col("s") * den >= F.col("l") * num)).select("token")
        slices.append(materialise(dealt.join(often.hint("shuffle_hash"), "token", "left_semi"), "shared"))
        del dealt, often
        free_shuffles(rows.sparkSession)
    listed = reduce(DataFrame.union, slices)
    if has_runs(num, den):
        least = F.when(F.col("n") >= LONG, COMMON).otherwise(1)
    else:
        least = F.least(F.lit(COMMON), F.ceil(F.col("n") * num / den))
    used = listed.groupBy("node").agg(F.count(F.lit(1)).alias("weight"), F.min("n").alias("n")).filter(F.col("weight") >= least)
    used = materialise(used.select("node", "weight"), "used")
    few = used.count() <= MAX_BROADCAST
    shared = listed.join(F.broadcast(used) if few else used, "node")
    part = lambda seed: F.sum(F.pmod(F.xxhash64(F.lit(seed), "node", "n"), F.lit(2**31))).alias(f"h{seed}")
    alike = shared.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("lo"), F.max("node").alias("hi"), part(1), part(2))
    alike = alike.filter("lo <> hi").groupBy("m", "lo", "hi", "h1", "h2").agg(F.min("token").alias("token"))
    groups = materialise(shared.join(alike.select("token"), "token", "left_semi").select("token", "node", "n", "weight"), "groups")
    discard(*slices, used)
    return groups


def jaccard_classes(
    docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 4, num: int = 85, den: int = 100
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``; links are Jaccard >= num/den.

    Rows with equal shingle sets are one node, the least id. Each two neighbours among a node's rarest
    tokens under the first order put it into one group. In a group, a few pivots are compared with all
    others, first the node that shares most, then the components found so far are applied, and pairs
    inside one component need no test any more; pivots leave, their number grows 64-fold a round, and
    groups that fit are compared whole once. Nodes whose short bitmaps are too far apart are no pair. So a group ends when it lies in one component or all
    its pairs were tested, and a large group of near copies costs one comparison a member. Only pairs
    whose bitmaps are near enough and that share prefix tokens under every further order have their
    whole sets compared.

    ``component_id`` is the least id reachable by links. Texts without words (null, empty) have no
    shingles and link to nothing; texts of fewer words than a shingle have their word sequence as
    the only one. Rows that repeat an id count as one document: what links to one links to all of
    them. A row with a null id has a null component and no links. Ids must be whole numbers.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("_text"))
    shared = spark.sparkContext.broadcast(frequent_shingles(plain, "_text", size))
    rows = materialise(_signatures(plain, "doc", "_text", size, num, den, shared), "signatures")
    nodes = (
        rows.filter(F.col("doc").isNotNull() & (F.col("n") > 0))
        .groupBy("same")
        .agg(F.min(F.struct("doc", "row")).alias("r"))
        .select("same", F.col("r.doc").alias("node"), F.col("r.row").alias("row"))
    )
    nodes = materialise(nodes, "nodes")
    members = materialise(rows.select("doc", "n", "same").join(nodes.select("same", "node"), "same", "left").drop("same"), "members")
    copies = rows.select("row").join(nodes.select("row"), "row", "left_anti")
    copies = materialise(copies, "copies")
    first_rows = rows.join(F.broadcast(copies) if copies.count() <= MAX_BROADCAST else copies, "row", "left_anti")
    groups = groups_table = _groups(first_rows, num, den)
    discard(rows, nodes, copies)
    used = groups.select("node").distinct()
    used = materialise(used, "used")
    ids = F.broadcast(used) if used.count() <= MAX_BROADCAST else used
    texts = plain.withColumnRenamed("doc", "node").join(ids, "node", "left_semi")
    profiles = materialise(_profiles(texts, "_text", size, num, den, shared), "profiles")
    done = groups
    groups = groups_table = materialise(groups.join(profiles.select("node", "n", *SHORT).distinct(), ["node", "n"]), "groups")
    discard(done, used)
    # nodes of different texts under one id
    shared_ids = members.groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("hi")).filter("a <> hi and doc is not null")
    free_shuffles(spark)
    links = materialise(members.join(shared_ids.select("doc", "a"), "doc").filter("a <> node").select("a", F.col("node").alias("b")), "links")
    components, pivots, first = None, 1, True
    apart = sum(F.bit_count(F.col(x).bitwiseXOR(F.col(f"a{x}"))) for x in SHORT)
    while True:
        placed = groups.withColumn("c", F.col("node"))
        if components is not None:
            placed = groups.join(components, F.col("node") == F.col("id"), "left").select(
                "token", "node", "n", "weight", *SHORT, F.coalesce("component", "node").alias("c")
            )
        open_ = placed.groupBy("token").agg(
            F.count(F.lit(1)).alias("m"),
            F.min("c").alias("lo"),
            F.max("c").alias("hi"),
            F.max(F.struct("weight", F.xxhash64("node").alias("h"), "node")).alias("p"),
        )
        open_ = open_.filter("lo <> hi").select("token", "m", F.col("p.node").alias("p"))
        drawn = F.pmod(F.xxhash64(F.lit(pivots), "node"), F.col("m")) < pivots
        pivot = (F.col("node") == F.col("p")) | (F.lit(not first) & ((F.col("m") <= SMALL_GROUP) | drawn))
        placed = materialise(placed.join(open_, "token").select("token", "node", "n", "weight", *SHORT, "c", pivot.alias("pivot")), "placed")
        if placed.isEmpty():
            break
        one = placed.filter("pivot").select("token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"), *[F.col(x).alias(f"a{x}") for x in SHORT])
        pairs = (
            placed.join(one, "token")
            .filter((F.col("c") != F.col("ca")) & (~F.col("pivot") | (F.col("a") < F.col("node"))))
            .filter((F.col("n") * den >= F.col("na") * num) & (F.col("na") * den >= F.col("n") * num))
            .filter(apart * (den + num) <= (F.col("n") + F.col("na")) * (den - num))
            .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
            .distinct()
        )
        links = links.union(_verified(pairs, profiles, num, den))
        components = materialise(connected_components(links, "a", "b"), "components")
        done, groups = groups_table, materialise(placed.filter(~F.col("pivot")).select("token", "node", "n", "weight", *SHORT), "groups")
        discard(done, placed)
        groups_table = groups
        pivots, first = pivots * 64, False
        free_shuffles(spark)
    if components is None:
        components = connected_components(links, "a", "b")
    discard(placed, groups_table, profiles)
    return members.join(components, F.col("node") == F.col("id"), "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("component", "node", "doc")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each class of near copies: that of the least id.

    Of rows repeating a kept id one stays (the least text); rows with a null id all stay.
    """
    classes = jaccard_classes(docs, id, text, **how)
    gone = materialise(classes.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    kept = docs.join(F.broadcast(gone) if gone.count() <= MAX_BROADCAST else gone, F.col(id) == F.col("_gone"), "left_anti")
    repeated = materialise(classes.groupBy("doc_id").count().filter("doc_id is not null and count > 1").select(F.col("doc_id").alias("_twice")), "repeated")
    free_shuffles(docs.sparkSession)
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, F.col(id) == F.col("_twice"), "left_semi")
    one = single.groupBy(F.col(id).alias("_id")).agg(F.min(F.struct(F.col(text), *[c for c in docs.columns if c != text])).alias("_r"))
    return kept.join(repeated, F.col(id) == F.col("_twice"), "left_anti").unionByName(one.select(*[F.col("_r").getField(c).alias(c) for c in docs.columns]))
