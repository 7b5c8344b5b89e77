"""URL filters: longest-prefix rules and a Bloom filter cascade for listed keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialise

from .common import LOWER, UPPER

#: Hash functions of a level, and bits for each key it encodes.
HASHES, BITS_PER_KEY = 5, 8
#: Filters are broadcast in slices of at most this many bytes; more slices mean more passes.
SLICE_BYTES = 32 << 20


def url_parts(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.coalesce(F.locate("://", F.col(url)), F.lit(0))
    rest = F.substring(F.col(url), at + 3, F.char_length(F.col(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    empty = F.lit("")
    return F.when(at > 0, F.translate(host, UPPER, LOWER)).otherwise(empty), F.when(at > 0, path).otherwise(empty)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule_column(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Struct of name and verdict of the longest rule that fits a host and a path, else null."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def domain_keys(host: Column) -> Column:
    """A host and its parent domains, longest first."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bit_positions(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """One row of ``HASHES`` bit positions for each key hash, by double hashing seeded with the level."""
    seed = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    a, b = _mix(hashes ^ seed), _mix(hashes + seed) | np.uint64(1)
    return (a[:, None] + np.arange(HASHES, dtype=np.uint64)[None, :] * b[:, None]) % np.uint64(bits)


def has_bits(field: np.ndarray, hashes: np.ndarray, level: int) -> np.ndarray:
    at = bit_positions(hashes, level, len(field) * 64)
    return ((field[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool).all(axis=1)


def answers(levels: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Membership of each key hash: the first level that denies it decides.

    A denial at an even level means not listed, at an odd level listed.
    """
    out, live = np.zeros(len(hashes), dtype=bool), np.arange(len(hashes))
    for i, field in enumerate(levels):
        hit = has_bits(field, hashes[live], i)
        out[live[~hit]] = i % 2 == 1
        live = live[hit]
    out[live] = len(levels) % 2 == 1
    return out


def _level_field(keys: DataFrame, n: int, level: int) -> np.ndarray:
    """Bit field of one level: tasks OR their own words, Spark ORs those, and the words come back."""
    bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)

    def words(batches):
        for pdf in batches:
            at = bit_positions(pdf.h.to_numpy(dtype=np.int64).view(np.uint64), level, bits).ravel()
            w, back = np.unique(at >> np.uint64(6), return_inverse=True)
            v = np.zeros(len(w), dtype=np.uint64)
            np.bitwise_or.at(v, back.ravel(), np.uint64(1) << (at & np.uint64(63)))
            yield pd.DataFrame({"w": w.view(np.int64), "v": v.view(np.int64)})

    got = keys.select("h").mapInPandas(words, "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v")).toPandas()
    out = np.zeros(bits // 64, dtype=np.int64)  # its size is bounded by the caller
    out[got.w.to_numpy(dtype=np.int64)] = got.v.to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _level_test(field, level: int):
    def run(h: pd.Series) -> pd.Series:
        return pd.Series(has_bits(field.value, h.to_numpy(dtype=np.int64).view(np.uint64), level))

    return F.pandas_udf(run, "boolean")


def _any_test(levels, slices: int, number: int):
    def run(hashes: pd.Series) -> pd.Series:
        if not levels.value or not len(hashes):
            return pd.Series(np.zeros(len(hashes), dtype=bool))
        sizes = hashes.map(len).to_numpy()
        every = np.concatenate([np.asarray(x, dtype=np.int64) for x in hashes])
        hit = answers(levels.value, every.view(np.uint64)) & (every % slices == number)
        return pd.Series(np.bincount(np.repeat(np.arange(len(sizes)), sizes), hit, len(sizes)) > 0)

    return F.pandas_udf(run, "boolean")


def build_cascade(keys: DataFrame, most_bytes: int = SLICE_BYTES) -> list[np.ndarray]:
    """Levels of a cascade that is exact on the universe ``keys`` (``h``: key hash, ``listed``).

    Level 0 holds the listed keys; level 1 the other keys that level 0 takes for listed; level 2
    the listed ones that level 1 takes for those; and so on until a level makes no error. The
    number of levels grows with the logarithm of the universe. Only a level's errors are kept
    for the next one, each known to be listed or not by its flag, so no join is needed.
    """
    spark = keys.sparkSession
    inside, outside = keys.filter("listed"), keys.filter("not listed")
    levels: list[np.ndarray] = []
    while n := inside.count():
        if n * BITS_PER_KEY // 8 > most_bytes:
            raise ValueError(f"a level of {n} keys needs more than {most_bytes} bytes; use more slices")
        level = len(levels)
        field = _level_field(inside, n, level)
        levels.append(field)
        shared = spark.sparkContext.broadcast(field)
        inside, outside = materialise(outside.filter(_level_test(shared, level)("h")), "errors"), inside
    return levels


def any_listed(rows: DataFrame, keys: str, universe: DataFrame, out: str, slice_keys: int = SLICE_BYTES * 8 // BITS_PER_KEY // 2) -> DataFrame:
    """``rows`` with a flag whether any of the keys in the array column ``keys`` is listed.

    ``universe`` has ``key, listed`` with every key that can occur in ``rows``, repeats allowed;
    on it the answer is exact. Keys are dealt by hash into as many slices as keep each level below
    ``SLICE_BYTES``. One slice is the common case. With more, each slice's filters are broadcast in
    a pass of their own and the flag is carried from pass to pass, so filters of any total size
    are never held at once. Null and empty arrays have no listed key.
    """
    spark = rows.sparkSession
    flat = (
        universe.filter(F.col("key").isNotNull())
        .groupBy(F.xxhash64("key").alias("h"))
        .agg(F.bool_or("listed").alias("listed"), F.bool_and("listed").alias("_all"))
    )
    flat = materialise(flat, "universe")
    row = flat.agg(F.count_if(F.col("listed") & ~F.col("_all")).alias("mixed"), F.count(F.lit(1)).alias("n")).first()
    if row.mixed:
        raise ValueError("a key, or two keys of one hash, are both listed and not listed")
    slices = max(1, -(-row.n // slice_keys))
    out_rows = rows.withColumn("_hashes", F.transform(F.coalesce(F.col(keys), F.array().cast("array<string>")), lambda k: F.xxhash64(k)))
    out_rows = out_rows.withColumn(out, F.lit(False))
    for i in range(slices):
        mine = flat.filter(F.pmod("h", F.lit(slices)) == i)
        shared = spark.sparkContext.broadcast(build_cascade(mine))
        out_rows = out_rows.withColumn(out, F.col(out) | _any_test(shared, slices, i)("_hashes"))
        if i + 1 < slices:
            out_rows = materialise(out_rows, "pass")
    return out_rows.drop("_hashes")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], is_listed: Callable[[Column], Column], url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``.

    The longest rule that fits decides. Where none fits, the verdict is ``block`` if the host or
    one of its parent domains is a listed key, else ``allow``. ``is_listed`` tells of a key column
    whether it is on the list; it is asked once, over the distinct keys of all pages, to build the
    cascade, which then answers each page. Null URLs and URLs without ``://`` have an empty host and
    path, no rule, and are allowed unless the empty key is listed; repeated URLs get equal
    verdicts; columns named like the results are replaced, others pass through.
    """
    names = ("host", "path", "rule", "verdict")
    host, path = url_parts(url)
    split = pages.withColumns({"_host": host, "_path": path})
    # copies of a host meet before its parent domains are made
    keys = split.select("_host").distinct().select(F.explode(domain_keys(F.col("_host"))).alias("key"))
    keys = keys.withColumn("listed", F.coalesce(is_listed(F.col("key")), F.lit(False)))
    split = split.withColumn("_keys", domain_keys(F.col("_host"))).withColumn("_rule", rule_column(rules, F.col("_host"), F.col("_path")))
    return any_listed(split, "_keys", keys, "_listed").select(
        *[c for c in pages.columns if c not in names],
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
