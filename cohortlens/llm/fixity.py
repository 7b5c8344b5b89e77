"""Merkle fixity audit of WARC replicas: compare roots, descend only where they differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialise

from .common import ordered_sums

#: Bytes of the lowest offset ranges, and children of a node.
RANGE_BYTES, FANOUT = 1 << 16, 16
_CRLF = "\r\n"


def warc_records(pages: DataFrame, id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """``record_id, url, record``: each page as one WARC/1.0 response record.

    Null URLs and bodies are written as empty. The payload digest is that of the body.
    """
    text = F.coalesce(F.col(body), F.lit(""))
    data = text.cast("binary")
    head = F.concat(
        F.lit(f"WARC/1.0{_CRLF}WARC-Type: response{_CRLF}WARC-Record-ID: <urn:page:"),
        F.coalesce(F.col(id).cast("string"), F.lit("")),
        F.lit(f">{_CRLF}WARC-Target-URI: "),
        F.coalesce(F.col(url), F.lit("")),
        F.lit(f"{_CRLF}WARC-Payload-Digest: sha256:"),
        F.sha2(data, 256),
        F.lit(f"{_CRLF}Content-Length: "),
        F.octet_length(data).cast("string"),
        F.lit(_CRLF * 2),
    )
    return pages.select(
        F.col(id).alias("record_id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.concat(head.cast("binary"), data, F.lit(_CRLF * 2).cast("binary")).alias("record"),
    )


def leaves(records: DataFrame, name: str) -> DataFrame:
    """Hash, length and file offset of every record, in the order of ids and hashes (written once).

    Each record is hashed where it is read; only hashes and lengths are sorted.
    """
    hashed = records.select(
        "record_id", F.sha2("record", 256).alias("hash"), F.octet_length("record").cast("long").alias("length")
    )
    return materialise(ordered_sums(hashed, [F.col("record_id"), F.col("hash")], F.col("length"), "position", "offset"), name)


def tree(parts: DataFrame, name: str, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of a Merkle tree from the lowest ranges up to the root, each ``node, hash``.

    A leaf belongs to the range its offset lies in, so a node's children are few: at most
    ``fanout`` nodes, or the records that start within ``range_bytes`` (a record's header bounds
    their number). A node hashes its children in order. Each level is written once.
    """
    def of(child: DataFrame, node: Column, at: Column) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct(at.alias("at"), F.col("hash").alias("hash"))))
        text = F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["at"].cast("string"), x["hash"])), ",")
        return child.groupBy(node.alias("node")).agg(F.sha2(text, 256).alias("hash"))

    levels = [materialise(of(parts, F.floor(F.col("offset") / range_bytes).cast("long"), F.col("offset")), f"{name}-0")]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    while top > 0:
        top //= fanout
        levels.append(materialise(of(levels[-1], F.floor(F.col("node") / fanout).cast("long"), F.col("node")), f"{name}-{len(levels)}"))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes whose hashes differ or that only one side has."""
    both = a.select("node", F.col("hash").alias("ha")).join(b.select("node", F.col("hash").alias("hb")), "node", "full")
    return both.filter(~F.col("ha").eqNullSafe(F.col("hb"))).select("node")


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Records in which two replicas differ, found from the roots down.

    ``first`` and ``second`` have ``record_id, record`` (or are ``leaves`` output). Trees of
    different height are compared from the lower one's top level. Only the children of nodes that
    differ are looked at on the next level, and at the end only the records of differing ranges
    are compared: by id and hash with multiplicity, so ties and repeated records count as often
    as they occur. Returns ``record_id, status, offset, length, other_offset, other_length``;
    status is ``corrupt`` (other bytes under the id), ``missing`` (only in the first), ``extra``
    (only in the second) or ``moved`` (same bytes at another offset). Null ids are ids of their
    own; equal replicas and empty tables give no row.
    """
    a = first if "offset" in first.columns else leaves(first, "leaves-a")
    b = second if "offset" in second.columns else leaves(second, "leaves-b")
    ta, tb = tree(a, "tree-a", range_bytes, fanout), tree(b, "tree-b", range_bytes, fanout)
    height = min(len(ta), len(tb))
    wrong = materialise(_differing(ta[height - 1], tb[height - 1]), "differ")
    for level in range(height - 2, -1, -1):
        inside = wrong.withColumnRenamed("node", "_up")
        up = F.floor(F.col("node") / fanout).cast("long")
        wrong = materialise(
            _differing(*[t[level].join(inside, up == F.col("_up"), "left_semi") for t in (ta, tb)]), "differ"
        )
    node = F.floor(F.col("offset") / range_bytes).cast("long").alias("node")

    def suspects(leaf: DataFrame, side: str) -> DataFrame:
        own = leaf.select("*", node).join(wrong, "node", "left_semi")
        return own.select("record_id", "hash", F.lit(side).alias("side"), "offset", "length")

    both = suspects(a, "a").union(suspects(b, "b"))
    each = both.groupBy("record_id", "hash").agg(
        F.count_if(F.col("side") == "a").alias("na"),
        F.count_if(F.col("side") == "b").alias("nb"),
        *[F.min(F.when(F.col("side") == s, F.col(c))).alias(f"{c}_{s}") for s in "ab" for c in ("offset", "length")],
    )
    per_id = each.groupBy("record_id").agg(
        F.sum(F.greatest(F.col("na") - F.col("nb"), F.lit(0))).alias("lost"),
        F.sum(F.greatest(F.col("nb") - F.col("na"), F.lit(0))).alias("new"),
        F.bool_or((F.col("na") > 0) & (F.col("nb") > 0) & (F.col("offset_a") != F.col("offset_b"))).alias("moved"),
        *[
            F.coalesce(F.min(F.when(F.col("na") != F.col("nb"), F.col(f"{c}_{s}"))), F.min(f"{c}_{s}")).alias(f"{c}_{s}")
            for s in "ab"
            for c in ("offset", "length")
        ],
    )
    status = (
        F.when((F.col("lost") > 0) & (F.col("new") > 0), "corrupt")
        .when(F.col("lost") > 0, "missing")
        .when(F.col("new") > 0, "extra")
        .when(F.col("moved"), "moved")
    )
    return per_id.select(
        "record_id",
        status.alias("status"),
        F.col("offset_a").alias("offset"),
        F.col("length_a").alias("length"),
        F.col("offset_b").alias("other_offset"),
        F.col("length_b").alias("other_length"),
    ).filter(F.col("status").isNotNull())


def damaged(pages: DataFrame, hit: Column, body: str = "html") -> DataFrame:
    """A second replica in which bits have rotted: where ``hit`` holds, the body's first ASCII
    letter is flipped between small and capital. Null bodies and bodies without one stay."""
    text = F.col(body)
    at = F.regexp_instr(text, F.lit("[A-Za-z]"))
    letter = F.substring(text, at, F.lit(1))
    other = F.when(letter == F.lower(letter), F.upper(letter)).otherwise(F.lower(letter))
    changed = F.concat(F.substring(text, F.lit(1), at - 1), other, F.substring(text, at + 1, F.length(text)))
    return pages.withColumn(body, F.when(hit & (at > 0), changed).otherwise(text))
