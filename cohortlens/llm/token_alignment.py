"""Alignment of two tokenizers' output over the same bytes, as Arrow columns from end to end."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialise

#: Bytes of text aligned at once, bytes of pieces tokenized at once, and links counted at once.
AT_ONCE, TOKENIZED, LINKS_AT_ONCE = 3_000_000, 500_000, 2_000_000
#: Both tokenizers end a token before a single space between two characters that are no white space.
CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
ALIGNED = "a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"
DESCRIBED = "n_a long, n_b long, n_groups long, groups_sha256 string, link_a array<int>, link_b array<int>, link_n array<int>"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, with the bytes of every id as Arrow arrays."""

    def __init__(self, json: bytes, model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task its cores
        self.a = Tokenizer.from_str(json.decode())
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_proto=model)
        letters = byte_letters()
        known = self.a.get_vocab(with_added_tokens=True)
        parts = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            parts[i] = bytes(letters[c] for c in token)
        self.a_bytes = pa.array(parts, pa.large_binary())
        pieces = [(self.b.is_byte(i), self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for _, p in pieces):
            raise ValueError("a piece holds a space after another character: texts cannot be cut before spaces")
        self.b_bytes = pa.array([bytes([int(p[3:5], 16)]) if raw else p.replace("▁", " ").encode() for raw, p in pieces], pa.large_binary())

    def encode(self, pieces: list[str]) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        """Ids of each piece, a piece being a space and what follows it; the second tokenizer adds that space itself."""
        a = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        b = self.b.encode([p[1:] for p in pieces], num_threads=1)
        return pa.array(a, pa.large_list(pa.int32())), pa.array(b, pa.large_list(pa.int32()))


def _tokens(ids: pa.LargeListArray, texts: pa.LargeBinaryArray, parts: pa.LargeBinaryArray) -> tuple[pa.Table, pa.Array]:
    """One row a token (piece, id, byte end in its piece), and for each piece whether its tokens' bytes are its text."""
    flat, piece = pc.list_flatten(ids), pc.list_parent_indices(ids)
    joined = parts.take(flat)
    ends = pc.cumulative_sum(pc.cast(pc.binary_length(joined), pa.int64()))
    # the sum up to a piece's last token, by which its own sums are counted from its start
    ends0 = pa.concat_arrays([pa.array([0], pa.int64()), ends])
    at = ends0.take(pc.subtract(ids.offsets, ids.offsets[0]))
    heads = at.slice(0, len(ids))
    whole = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, at.buffers()[1], joined.buffers()[2] or pa.py_buffer(b"")])
    table = pa.table({"piece": piece, "id": flat, "end": pc.subtract(ends, heads.take(piece))})
    return table, pc.equal(whole, texts)


def _encoded(pair: Pair, pieces: list[str]) -> tuple[pa.Table, pa.Table, pa.Array]:
    """Tokens of all pieces under both tokenizers; block by block, as the tokenizers' own objects are large."""
    sides, good, first, start = ([], []), [pa.array([], pa.bool_())], 0, 0
    while start < len(pieces):
        end, size = start, 0
        while end < len(pieces) and (end == start or size + len(pieces[end]) <= TOKENIZED):
            size += len(pieces[end])
            end += 1
        block = pieces[start:end]
        raw = pa.array([p.encode() for p in block], pa.large_binary())
        same = []
        for side, ids, parts in zip(sides, pair.encode(block), (pair.a_bytes, pair.b_bytes)):
            tokens, equal = _tokens(ids, raw, parts)
            side.append(tokens.set_column(0, "piece", pc.add(pc.cast(tokens["piece"], pa.int64()), first)))
            same.append(equal)
        good.append(pc.and_(*same))
        first += len(block)
        start = end
    empty = pa.table({"piece": pa.array([], pa.int64()), "id": pa.array([], pa.int32()), "end": pa.array([], pa.int64())})
    a, b = (pa.concat_tables([empty, *side]).combine_chunks() for side in sides)
    return a, b, pa.concat_arrays(good)


def _lists(values: pa.Array, counts: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pc.cast(_starts(counts), pa.int32()), values)


def _starts(counts: pa.Array) -> pa.Array:
    """Where each run of ``counts`` rows starts, and where the last one ends."""
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(pc.cast(counts, pa.int64()))])


def _counts(owner: pa.Array, n: int) -> pa.Array:
    """How many rows each of ``n`` owners has."""
    found = pa.table({"owner": owner}).group_by("owner", use_threads=False).aggregate([([], "count_all")])
    every = pa.table({"owner": pa.array(np.arange(n))})
    joined = every.join(found, "owner", join_type="left outer", use_threads=False).sort_by("owner")
    return pc.fill_null(joined["count_all"].combine_chunks(), 0)


def _column(table: pa.Table, name: str) -> pa.Array:
    return table[name].combine_chunks()


def align_pieces(pair: Pair, pieces: list[str]) -> pa.RecordBatch:
    """For each piece its ids under both tokenizers, the numbers of ids in each group, and whether the bytes agree.

    A piece that does not agree has empty lists. Groups end where tokens of both sides end: the
    token ends of both sides are hash-joined on piece and offset.
    """
    *sides, good = _encoded(pair, pieces)
    n = len(pieces)
    for i, tokens in enumerate(sides):
        kept = tokens.filter(good.take(_column(tokens, "piece")))
        sides[i] = kept.append_column("at", pa.array(np.arange(len(kept))))
    a, b = sides
    ends = a.select(["piece", "end", "at"]).join(
        b.select(["piece", "end", "at"]), ["piece", "end"], join_type="inner", right_suffix="_b", use_threads=False
    ).sort_by("at")
    # a piece's last tokens end together, so a group's tokens are those since the group before, over pieces too
    sizes = lambda c: pc.cast(pc.subtract(c, pa.concat_arrays([pa.array([-1], pa.int64()), c])[:-1]), pa.int32())
    groups = _counts(_column(ends, "piece"), n)
    lists = [_lists(_column(t, "id"), _counts(_column(t, "piece"), n)) for t in sides]
    lists += [_lists(sizes(_column(ends, c)), groups) for c in ("at", "at_b")]
    return pa.RecordBatch.from_arrays([*lists, good], names=["a_ids", "b_ids", "a_sizes", "b_sizes", "good"])


class Texts:
    """Texts as rows of pieces; what a piece has is worked out once for all its places."""

    def __init__(self, pair: Pair, texts: list[str | None]):
        pieces = [CUT.split(t) if t else [] for t in texts]
        counts = pa.array([len(p) for p in pieces], pa.int64())
        coded = pa.array([f" {p}" for own in pieces for p in own], pa.string()).dictionary_encode()
        self.pieces = align_pieces(pair, coded.dictionary.to_pylist())
        codes = pc.cast(coded.indices, pa.int64())
        # a text with a piece that does not agree has no tokens at all
        owner = pa.array(np.repeat(np.arange(len(texts)), counts.to_numpy()))
        bad = pc.unique(owner.filter(pc.invert(self.pieces.column("good").take(codes))))
        self.n = len(texts)
        self.codes = codes.filter(pc.invert(pc.is_in(owner, value_set=bad)))
        self.counts = pc.if_else(pc.is_in(pa.array(np.arange(self.n)), value_set=bad), 0, counts)

    def lists(self, values: pa.ListArray) -> pa.ListArray:
        """A list for each text: those of its pieces in a row."""
        taken = values.take(self.codes)
        ends = _starts(pc.list_value_length(taken)).take(_starts(self.counts))
        return pa.ListArray.from_arrays(pc.cast(ends, pa.int32()), pc.list_flatten(taken))

    def sums(self, values: pa.Array) -> pa.Array:
        """A sum for each text over its pieces."""
        ends = _starts(values.take(self.codes)).take(_starts(self.counts))
        return pc.subtract(ends[1:], ends[:-1])


def _last(pieces: pa.RecordBatch, side: str) -> pa.ListArray:
    """The last id of each group of each piece."""
    ids, sizes = pieces.column(f"{side}_ids"), pieces.column(f"{side}_sizes")
    ends = pc.cumulative_sum(pc.cast(pc.list_flatten(sizes), pa.int64()))
    return _lists(pc.list_flatten(ids).take(pc.subtract(ends, 1)), pc.list_value_length(sizes))


def _group_text(pieces: pa.RecordBatch) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` for each piece: ids of A and B by groups."""
    written = []
    for side in "ab":
        ids = pc.cast(pc.list_flatten(pieces.column(f"{side}_ids")), pa.string())
        written.append(pc.binary_join(_lists(ids, pc.list_flatten(pieces.column(f"{side}_sizes"))), ","))
    groups = pc.binary_join_element_wise(*written, "|")
    return pc.binary_join(_lists(groups, pc.list_value_length(pieces.column("a_sizes"))), ";")


def align_texts(pair: Pair, texts: list[str | None]) -> list[pa.Array]:
    """The columns of ``ALIGNED``."""
    found = Texts(pair, texts)
    return [found.lists(found.pieces.column(c)) for c in ("a_ids", "b_ids", "a_sizes", "b_sizes")]


def describe_texts(pair: Pair, texts: list[str | None]) -> list[pa.Array]:
    """The columns of ``DESCRIBED``.

    Tokens have bytes, so at one offset at most one token of each side ends, and a group holds one
    link, that of its last tokens. Links are counted by text and id pair.
    """
    found = Texts(pair, texts)
    sizes = [found.sums(pc.cast(pc.list_value_length(found.pieces.column(c)), pa.int64())) for c in ("a_ids", "b_ids", "a_sizes")]
    written = _group_text(found.pieces).take(found.codes)
    shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in pc.binary_join(_lists(written, found.counts), ";").to_pylist()]
    a, b = (found.lists(_last(found.pieces, side)) for side in "ab")
    links = pa.table({"text": pc.cast(pc.list_parent_indices(a), pa.int64()), "a": pc.list_flatten(a), "b": pc.list_flatten(b)})
    links = links.group_by(["text", "a", "b"], use_threads=False).aggregate([([], "count_all")]).sort_by("text")
    many = _counts(_column(links, "text"), found.n)
    lists = [_lists(pc.cast(_column(links, c), pa.int32()), many) for c in ("a", "b", "count_all")]
    return [*sizes, pa.array(shas, pa.string()), *lists]


def _slices(batch: pa.RecordBatch, weights: pa.Array, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows that weigh up to ``limit`` together; a heavier row is a run of its own."""
    start, total = 0, 0
    for i, w in enumerate(weights.to_pylist()):
        if i > start and total + w > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += w
    if start < batch.num_rows:
        yield batch.slice(start)


class Aligner:
    """A byte-level vocabulary (A) and a piece vocabulary with byte fallback (B).

    Their files are a few megabytes of fixed size and are broadcast once.
    """

    def __init__(self, spark, a: str, b: str):
        files = []
        for path in (a, b):
            with open(path, "rb") as f:
                files.append(f.read())
        self.shared = spark.sparkContext.broadcast(tuple(files))

    def _by_text(self, docs: DataFrame, id: str, text: str, work, schema: str) -> DataFrame:
        shared, names = self.shared, [id, *(c.split()[0] for c in schema.split(", "))]

        def run(batches):
            pair = Pair(*shared.value)
            for batch in batches:
                sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0)
                for part in _slices(batch, sizes, AT_ONCE):
                    yield pa.RecordBatch.from_arrays([part.column(0), *work(pair, part.column(1).to_pylist())], names=names)

        kind = docs.schema[id].dataType.simpleString()
        return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"`{id}` {kind}, {schema}")

    def align(self, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
        """``id, a_ids, b_ids, a_sizes, b_sizes`` of every row: ids of " " + text under A and of text under B.

        Group g of a text takes the next ``a_sizes[g]`` ids of A and the next ``b_sizes[g]`` of B; a group
        ends at each byte offset where tokens of both end. Texts that are null or empty, or whose tokens'
        bytes under A or B are not the text's, have empty lists. Repeated rows and null ids are rows like
        any other, and further columns of ``docs`` play no part.

        Texts are cut before single spaces, where both tokenizers end a token whatever stands around, and
        each different piece of a batch is tokenized and aligned once.
        """
        return self._by_text(docs, id, text, align_texts, ALIGNED)

    def describe(self, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
        """``id, n_a, n_b, n_groups, groups_sha256`` of the same alignment, and each text's links by id pair.

        ``groups_sha256`` is the digest of the groups written as ``a1,a2|b1;a3|b2,b3``, '' without tokens.
        A text's links of the pair ``link_a[i], link_b[i]`` are ``link_n[i]`` many.
        """
        return self._by_text(docs, id, text, describe_texts, DESCRIBED)


def _links(batch: pa.RecordBatch) -> pa.Table:
    """One row for each row of the batch and id pair."""
    columns = {c: pc.list_flatten(batch.column(f"link_{c}")) for c in "abn"}
    row = pc.cast(pc.list_parent_indices(batch.column("link_a")), pa.int64())
    return pa.table({"row": row, "a": columns["a"], "b": columns["b"], "n": pc.cast(columns["n"], pa.int64())})


def _parts(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _slices(batch, pc.list_value_length(batch.column("link_a")), LINKS_AT_ONCE)


def pair_counts(described: DataFrame) -> DataFrame:
    """``a, b, n``: how many links of all texts hold an id pair; each task adds up its own first."""

    def run(batches):
        total = pa.table({"a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
        for part in _parts(batches):
            both = pa.concat_tables([total, _links(part).select(["a", "b", "n"])])
            total = both.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["a", "b", "n"])
        yield from total.to_batches()

    partial = described.select("link_a", "link_b", "link_n").mapInArrow(run, "a int, b int, n long")
    return partial.groupBy("a", "b").agg(F.sum("n").alias("n"))


def possible_pairs(pair: Pair) -> int:
    """How many id pairs can be linked at all: those of which one's bytes end the other's.

    Linked tokens end at one offset of one text, so the shorter is the end of the longer. The number
    belongs to the two vocabularies, not to the corpus.
    """
    sides = [[x for x in side.to_pylist() if x] for side in (pair.a_bytes, pair.b_bytes)]
    total = 0
    for one, other, first in ((*sides, 0), (*sides[::-1], 1)):
        have: dict[bytes, int] = {}
        for x in other:
            have[x] = have.get(x, 0) + 1
        total += sum(have.get(x[k:], 0) for x in one for k in range(first, len(x)))
    return total


def score(described: DataFrame, counts: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every described text.

    ``counts`` are the pair counts. A link is best if no pair of its B id is counted more often;
    ``count_sum`` adds the counts over a text's links. The counts have a row for each id pair seen, of
    which there are at most ``possible_pairs``, so they are broadcast.
    """
    shared = described.sparkSession.sparkContext.broadcast(counts.select("a", "b", "n").toArrow())

    def run(batches):
        known = shared.value.rename_columns(["a", "b", "count"])
        most = known.group_by("b", use_threads=False).aggregate([("count", "max")])
        known = known.join(most, "b", use_threads=False)
        known = known.append_column("best", pc.cast(pc.equal(known["count"], known["count_max"]), pa.int64())).drop_columns("count_max")
        for part in _parts(batches):
            links = _links(part).join(known, ["a", "b"], use_threads=False)
            for name in ("count", "best"):
                links = links.append_column(f"{name}s", pc.multiply(links[name], links["n"]))
            sums = links.group_by("row", use_threads=False).aggregate([("n", "sum"), ("bests", "sum"), ("counts", "sum")])
            rows = pa.table({"row": pa.array(np.arange(part.num_rows))}).join(sums, "row", use_threads=False).sort_by("row")
            filled = [pc.fill_null(_column(rows, c), 0) for c in ("n_sum", "bests_sum", "counts_sum")]
            yield pa.RecordBatch.from_arrays([part.column(0), *(part.column(c) for c in told), *filled], names=[id, *told, "n_links", "n_best", "count_sum"])

    told = ["n_a", "n_b", "n_groups", "groups_sha256"]
    kind = described.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long"
    return described.select(id, *told, "link_a", "link_b", "link_n").mapInArrow(run, schema)


def token_alignment(aligner: Aligner, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all texts; they are tokenized once and their descriptions written, as counts come before scores."""
    described = materialise(aligner.describe(docs, id, text), "described")
    return score(described, pair_counts(described), id)
