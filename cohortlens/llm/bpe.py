"""Byte-level BPE: recursive contraction of token rows in DuckDB, one database for each Spark task."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory

#: Words and segments a task remembers; it forgets them all when there are more.
MAX_WORDS = 700_000
#: Words of one recursive query, tokens of one decoding query, and bytes from which words count as long.
WORDS_AT_ONCE, TOKENS_AT_ONCE, LONG_WORD = 40_000, 2_000_000, 256


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 and number on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """``l, r, rank``: every pair of tokens whose bytes together are a token."""
    rows = [
        (ranks[t[:i]], ranks[t[i:]], k) for t, k in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
    ]
    return pa.table({n: np.array(c, dtype=np.int32) for n, c in zip(("l", "r", "rank"), zip(*rows))})


#: Token rows, keyed by word number and byte position, joined to the merges; each round contracts
#: every word's leftmost pair of minimum rank, and words without a pair leave.
_SHORT = """
WITH RECURSIVE step(q, t, live) AS (
  SELECT w::BIGINT * 4294967296 + p, t, true FROM start
  UNION ALL
  (WITH pair AS (
      SELECT q, t, lead(q) OVER o AS nq, lead(t) OVER o AS nt, lag(q) OVER o AS pq FROM step WHERE live WINDOW o AS (ORDER BY q)),
   ranked AS (
      SELECT pair.*, q >> 32 AS w, m.rank::BIGINT * 4294967296 + (q & 4294967295) AS k
      FROM pair LEFT JOIN merge m ON m.l = pair.t AND m.r = pair.nt AND nq >> 32 = q >> 32),
   best AS (SELECT w, min(k) AS b FROM ranked WHERE k IS NOT NULL GROUP BY w)
   SELECT q, CASE WHEN k = b THEN (b >> 32)::INTEGER ELSE t END, b IS NOT NULL FROM ranked LEFT JOIN best USING (w)
   WHERE b IS NULL OR pq IS NULL OR pq <> (w << 32) + (b & 4294967295))
)
SELECT q, t FROM step WHERE NOT live"""

#: The same for one long word, contracting from left to right all places of the pair of minimum rank
#: (every other one of a run of overlapping places) up to the first whose new token makes a pair of
#: the same or a lower rank with a neighbour: till then, one at a time would do the same.
_LONG = """
WITH RECURSIVE step(q, t, live) AS (
  SELECT p::BIGINT, t, true FROM start
  UNION ALL
  (WITH pair AS (
      SELECT q, t, lead(t) OVER o AS nt, lag(t) OVER o AS lt, lead(t, 2) OVER o AS rt FROM step WHERE live WINDOW o AS (ORDER BY q)),
   ranked AS (SELECT pair.*, m.rank FROM pair LEFT JOIN merge m ON m.l = pair.t AND m.r = pair.nt),
   best AS (SELECT (min(rank::BIGINT * 4294967296 + q) >> 32)::INTEGER AS k FROM ranked),
   on_left AS (SELECT l AS x FROM merge, best WHERE r = k AND rank <= k),
   on_right AS (SELECT r AS x FROM merge, best WHERE l = k AND rank <= k),
   hit AS (SELECT q, t, k, coalesce(rank = k, false) AS h, a.x IS NOT NULL OR b.x IS NOT NULL OR k IN (SELECT x FROM on_left) AS stir
      FROM best, ranked LEFT JOIN on_left a ON a.x = lt LEFT JOIN on_right b ON b.x = rt),
   till AS (SELECT coalesce(min(q), 9223372036854775807) AS z FROM hit WHERE h AND stir),
   run AS (SELECT q, t, k, h AND q <= z AS h, sum(CASE WHEN h AND q <= z THEN 0 ELSE 1 END) OVER (ORDER BY q ROWS UNBOUNDED PRECEDING) AS g FROM hit, till),
   place AS (SELECT *, h AND row_number() OVER (PARTITION BY g, h ORDER BY q) % 2 = 1 AS s FROM run),
   near AS (SELECT *, lag(s) OVER (ORDER BY q) AS gone FROM place)
   SELECT q, CASE WHEN s THEN k ELSE t END, k IS NOT NULL FROM near WHERE gone IS NULL OR NOT gone)
)
SELECT q, t FROM step WHERE NOT live"""


#: A segment ends before each space that follows something other than white space. A word of the
#: pattern never goes across such a place, and the words of a segment do not depend on its neighbours.
SEGMENT_END = re.compile(r"(?<=\S)(?= )")


#: Segments of Latin letters only are words of any pattern that keeps letters and a leading space together.
WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


class Codec:
    """Encoder and decoder of one task, with its own in-memory database.

    ``pattern`` must keep a run of letters and the space before it together, as byte-level BPE does.
    """

    def __init__(self, ranks: dict[bytes, int], merges: pa.Table, pattern: str):
        import duckdb
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "350MB", "temp_directory": ""})
        self.db.register("merge_arrow", merges)
        self.db.execute("CREATE TABLE merge AS SELECT l, r, rank FROM merge_arrow")
        # one character above 255 for each byte, so that token texts are valid and keep their bytes
        texts = ["".join(chr(256 + b) for b in t) for t in ranks]
        self.db.register("vocab_arrow", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "part": texts}))
        self.db.execute("CREATE TABLE vocab AS SELECT id, part FROM vocab_arrow")
        self.single = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)

    def forget(self) -> None:
        """Drop the remembered words and segments."""
        self.words.clear()
        self.known.clear()

    def learn(self, words: set[str]) -> None:
        """Ids of words not met before: a word that is a token is that token, others are contracted."""
        todo: list[tuple[str, bytes]] = []
        for w in words:
            raw = w.encode("utf-8", "surrogatepass")
            if raw in self.ranks:
                self.words[w] = self.ranks[raw].to_bytes(4, "little")
            else:
                todo.append((w, raw))
        short = [x for x in todo if len(x[1]) < LONG_WORD]
        for i in range(0, len(short), WORDS_AT_ONCE):
            self._contract(short[i : i + WORDS_AT_ONCE], _SHORT)
        for x in todo:
            if len(x[1]) >= LONG_WORD:
                self._contract([x], _LONG)

    def _contract(self, words: list[tuple[str, bytes]], query: str) -> None:
        lens = np.array([len(raw) for _, raw in words])
        w = np.repeat(np.arange(len(words), dtype=np.int32), lens)
        p = (np.arange(len(w)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32)
        t = self.single[np.frombuffer(b"".join(raw for _, raw in words), np.uint8)]
        self.db.register("start", pa.table({"w": w, "p": p, "t": t}))
        got = self.db.execute(query).fetchnumpy()
        self.db.unregister("start")
        q, t = np.asarray(got["q"]), np.asarray(got["t"])
        by = np.argsort(q)
        q, t = q[by], t[by].astype("<u4")
        cut = np.searchsorted(q, np.arange(len(words) + 1, dtype=np.int64) << 32) if len(words) > 1 else np.array([0, len(q)])
        for i, (word, _) in enumerate(words):
            self.words[word] = t[cut[i] : cut[i + 1]].tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        pieces = [SEGMENT_END.split(t) for t in texts]
        if len(self.words) > MAX_WORDS or len(self.known) > MAX_WORDS:
            self.forget()
        known = self.known
        new = {s for p in pieces for s in p if s not in known}
        split = {s: [s] if WORD.fullmatch(s) else self.find(s) for s in new}
        words = {w for p in split.values() for w in p if w not in self.words}
        if words:
            self.learn(words)
        for s, w in split.items():
            known[s] = self.words[w[0]] if len(w) == 1 else b"".join([self.words[x] for x in w])
        return [np.frombuffer(b"".join([known[s] for s in p]), dtype="<u4") for p in pieces]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each id list: token texts joined to their rows and aggregated in order."""
        out: list[bytes] = [b""] * len(ids)
        first, total = 0, 0
        for i in range(len(ids) + 1):
            if i == len(ids) or total + len(ids[i]) > TOKENS_AT_ONCE and total:
                self._decode(ids[first:i], first, out)
                first, total = i, 0
            if i < len(ids):
                total += len(ids[i])
        return out

    def _decode(self, ids: list[np.ndarray], first: int, out: list[bytes]) -> None:
        lens = [len(x) for x in ids]
        if not sum(lens):
            return
        d = np.repeat(np.arange(len(ids), dtype=np.int32), lens)
        flat = np.concatenate(ids).astype(np.int32)
        self.db.register("token", pa.table({"d": d, "p": np.arange(len(flat), dtype=np.int32), "id": flat}))
        rows = self.db.execute("SELECT d, string_agg(part, '' ORDER BY p) AS text FROM token JOIN vocab USING (id) GROUP BY d").fetchall()
        self.db.unregister("token")
        for i, text in rows:
            out[first + i] = text.encode("utf-16-le")[::2]  # the low byte of each character


def codec_of(shared) -> Codec:
    """The codec of this worker process; it stays with the broadcast, so later tasks reuse its words."""
    value = shared.value
    if "codec" not in value:
        value["codec"] = Codec(*value["vocabulary"])
    return value["codec"]


class Bpe:
    """A rank file and a word pattern, ready to be used in Spark tasks.

    The tables of a vocabulary are a few megabytes of fixed size and are broadcast once.
    """

    def __init__(self, spark, path: str, pattern: str):
        ranks = read_ranks(path)
        self.shared = spark.sparkContext.broadcast({"vocabulary": (ranks, merge_table(ranks), pattern)})

    def _batches(self, frames: Iterator[pd.DataFrame], text: str) -> Iterator[tuple[pd.DataFrame, list[np.ndarray], Codec]]:
        codec = codec_of(self.shared)
        for pdf in frames:
            texts = [t if isinstance(t, str) else "" for t in pdf[text]]
            start = 0
            while start < len(texts):  # blocks of bounded size; one long text is a block of its own
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= 4_000_000):
                    size += len(texts[end])
                    end += 1
                yield pdf.iloc[start:end], codec.encode(texts[start:end]), codec
                start = end

    def encode(self, docs: DataFrame, text: str = "text", out: str = "ids") -> DataFrame:
        """``docs`` with the token ids of each text as an array; none for null and empty texts.

        A column named ``out`` is replaced. A task forgets its words when it ends, so that a worker
        that goes on to other work holds no more than the vocabulary.
        """
        this, kept = self, [c for c in docs.columns if c != out]
        names = [f"_{i}" for i in range(len(kept))]  # no name of the caller's can clash

        def run(frames):
            codec = codec_of(this.shared)
            for pdf, ids, _ in this._batches(frames, "_t"):
                yield pdf.drop(columns="_t").assign(_ids=[x.view(np.int32) for x in ids])
            codec.forget()
            release_memory()

        schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, kept)) + ", _ids array<int>"
        plain = docs.select(*(F.col(f"`{c}`").alias(n) for n, c in zip(names, kept)), F.col(text).alias("_t"))
        return plain.mapInPandas(run, schema).toDF(*kept, out)

    def decode(self, tokens: DataFrame, ids: str = "ids", out: str = "bytes") -> DataFrame:
        """``tokens`` with the bytes that each id array stands for; empty for null and empty arrays."""
        shared = self.shared

        def run(frames):
            codec = codec_of(shared)
            for column in frames:
                yield pd.Series(codec.decode([np.zeros(0, np.uint32) if x is None else np.asarray(x, dtype=np.uint32) for x in column]))

        # pandas' iterator form keeps one codec for all batches of a task
        def typed(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
            return run(frames)

        return tokens.withColumn(out, F.pandas_udf(typed, "binary")(ids))

    def round_trip(self, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
        """``id, n_tokens, ids_sha256, decoded_sha256``: each text encoded and decoded in one task.

        Digests are those of the ids as little-endian 32-bit numbers and of the decoded bytes. Null
        texts count as empty; repeated rows and null ids are rows like any other.
        """
        this = self

        def run(frames):
            for pdf, ids, codec in this._batches(frames, "_t"):
                yield pd.DataFrame(
                    {
                        "id": pdf["id"],
                        "n_tokens": [len(x) for x in ids],
                        "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids],
                        "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in codec.decode(ids)],
                    }
                )

        kind = docs.schema[id].dataType.simpleString()
        schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
        return docs.select(F.col(id).alias("id"), F.col(text).alias("_t")).mapInPandas(run, schema).withColumnRenamed("id", id)
