"""Bottom-k fingerprints of word shingles, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import partitions, word_list

#: Words of a shingle and hashes kept; the standard error of a likeness j is sqrt(j (1 - j) / K).
SHINGLE, K = 5, 256


def sketch(text: Column, shingle: int = SHINGLE, k: int = K) -> Column:
    """The ``k`` least distinct shingle hashes of a text, ascending; empty for no words.

    A text of fewer words than a shingle has its whole word sequence as the only one. Hashes are
    64 bits; two sketches of parts merge into the sketch of the union with ``merged``.
    """
    words = word_list(text)

    def of(w: Column) -> Column:
        n = F.size(w)
        several = F.transform(
            F.sequence(F.lit(1), n - (shingle - 1)), lambda i: F.xxhash64(F.slice(w, i, shingle))
        )
        return F.when(n == 0, F.array().cast("array<bigint>")).when(n < shingle, F.array(F.xxhash64(w))).otherwise(several)

    # one-element transform: the word list is evaluated once and bound to a name
    hashes = F.element_at(F.transform(F.array(words), of), 1)
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two texts' shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def _shared(a: Column, b: Column, k: int) -> tuple[Column, Column]:
    """Hashes of the union sketch, and how many of them both sides have."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.size(union), both


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles in all shingles of both (0 if neither has any)."""
    size, both = _shared(a, b, k)
    return F.when(size == 0, F.lit(0.0)).otherwise(both.cast("double") / size)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    span = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / span)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too (0 if ``a`` has none)."""
    j = resemblance(a, b, k)
    union = distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), j * union / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as text: sixteen hex digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(docs: DataFrame, order: str, columns: list[str], prefix: str = "next_") -> DataFrame:
    """``docs`` with ``columns`` of the next row by ``order``; the last row gets the first one's.

    Keys are cut into ranges at approximate quantiles. The first row of every range is sent to
    the range before it as well, so one window inside each range finds every successor. What a
    range is told is joined to its rows, so the plan does not grow with their number. Ties are
    ordered by all ``columns``; rows whose key is null come before the others. Keys are numbers.
    """
    n = partitions(docs.sparkSession) * 2
    cuts = docs.select(F.col(order).cast("double").alias("o")).approxQuantile("o", [i / n for i in range(1, n)], 0.25 / n)
    cuts = sorted(set(cuts))
    rough = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c <= F.col(order).cast("double")))
    rough = F.when(F.col(order).isNull(), F.lit(-1)).otherwise(rough).cast("long")
    ranged = docs.withColumn("_range", rough)
    # one row per range, a number set by the partition count
    order_of_ranges = W.Window.orderBy("_range")
    every = W.Window.partitionBy(F.lit(0))
    firsts = ranged.groupBy("_range").agg(F.min(order).alias("_first")).withColumn("_n", F.row_number().over(order_of_ranges) - 1)
    places = firsts.withColumn("_before", F.pmod(F.col("_n") - 1, F.count(F.lit(1)).over(every).cast("int")))
    to = lambda place, last: F.struct(F.col(place).alias("to"), F.lit(last).alias("last"))
    copies = F.when(F.col(order).eqNullSafe(F.col("_first")), F.array(to("_n", 0), to("_before", 1))).otherwise(F.array(to("_n", 0)))
    spread = ranged.join(F.broadcast(places), "_range").withColumn("_copy", F.explode(copies))
    inside = W.Window.partitionBy("_copy.to").orderBy("_copy.last", order, *[c for c in columns if c != order])
    follow = F.lead(F.struct(*columns)).over(inside)
    return (
        spread.withColumn("_next", follow)
        .filter("_copy.last = 0")
        .select(*docs.columns, *[F.col("_next").getField(c).alias(f"{prefix}{c}") for c in columns])
    )


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likenesses.

    Returns ``id, n_chars, edited (text), sketch, edited_sketch, next_sketch``. The edited text
    has its last quarter of characters replaced by as many from the start of the next document's
    text (or all of it, if that is shorter). Null texts count as empty and an empty text has the
    empty sketch; repeated rows follow each other; a single document follows itself.
    """
    plain = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    n = F.char_length("_text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - quarter), F.substring(F.col("next__text"), F.lit(1), quarter))
    return with_next(plain, "_id", ["_id", "_text"]).select(
        F.col("_id").alias("doc_id"),
        n.cast("long").alias("n_chars"),
        edited.alias("edited"),
        sketch(F.col("_text"), shingle, k).alias("sketch"),
        sketch(edited, shingle, k).alias("edited_sketch"),
        sketch(F.col("next__text"), shingle, k).alias("next_sketch"),
    )
