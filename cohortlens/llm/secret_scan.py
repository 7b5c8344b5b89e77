"""Secrets in texts: pattern scan of every decoded layer, with spans mapped back to the text."""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
# a run that is long enough as a whole is the same as a run that is dropped when short
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

ESCAPE = re.compile(
    r"(?P<pct>(?:%[0-9A-Fa-f]{2})+)"
    r"|\\u\{(?P<brace>[0-9A-Fa-f]{1,6})\}"
    r"|(?P<pair>\\u[Dd][89ABab][0-9A-Fa-f]{2}\\u[Dd][C-Fc-f][0-9A-Fa-f]{2})"
    r"|\\u(?P<u4>[0-9A-Fa-f]{4})|\\U(?P<u8>[0-9A-Fa-f]{8})|\\x(?P<x2>[0-9A-Fa-f]{2})"
    r"|&#(?P<dec>[0-9]{1,7});|&#[xX](?P<hexa>[0-9A-Fa-f]{1,6});"
)
# lines of a wrapped block and a last line of any length, or a run of its own
BASE64 = re.compile(
    r"(?:[A-Za-z0-9+/_-]{60,}\r?\n)+(?:[A-Za-z0-9+/_-]+={0,2}|={1,2})|[A-Za-z0-9+/_-]{16,}={0,2}"
)
#: What any finding in decoded bytes needs; bytes without it are not read as a layer.
LOOK = re.compile(
    rb"(?i:password|passwd|secret|token|api_?key)|[A-Za-z0-9+/_-]{16}|%[0-9A-Fa-f]{2}|\\[uUx]|&#"
)
#: UTF-16 text of six characters and more.
WIDE = re.compile(rb"(?:[^\x00]\x00){6,}", re.S)
#: First bytes of gzip, bzip2, xz and zlib data.
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x78[\x01\x5e\x9c\xda]")
#: Escapes that can stand for single bytes, with the numbers of the digits' groups.
BYTES = (
    ("%", re.compile(rb"%([0-9A-Fa-f]{2})")),
    ("\\", re.compile(rb"\\(?:x([0-9A-Fa-f]{2})|u00([0-9A-Fa-f]{2})|(?P<short>[abfnrtv0\"'/\\]))")),
    ("&", re.compile(rb"&(?:#[xX]0*([0-9A-Fa-f]{2});|#0*(?P<dec>[0-9]{1,3});|(?P<name>amp|lt|gt|quot);)")),
)
SHORT = dict(zip(b"abfnrtv0\"'/\\", b"\a\b\f\n\r\t\v\0\"'/\\"))
NAMES = {b"amp": b"&", b"lt": b"<", b"gt": b">", b"quot": b'"'}
#: Content beyond this is read in blocks of this size that overlap by an eighth; ``n_too_large`` counts it.
MAX_LAYER = 64 << 20
#: Bytes that a decompressor takes and gives at once.
PIECE = 1 << 20

SCHEMA = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long, "
    "n_layers long, n_too_large long, masked string"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every match in one layer."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def _tool(head: bytes):
    """Decompressor for data that begins so; None if it is not packed."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 2 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj(15)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(memlimit=256 << 20)
    return None


def unpacked(data: bytes, at: int, end: list[int]):
    """Content in pieces of the gzip, zlib, bzip2 and xz streams that follow each other from ``at`` on.

    ``end[0]`` becomes the place behind the last of them. A broken one ends the content.
    """
    view = memoryview(data)
    while (tool := _tool(bytes(view[at : at + 6]))) is not None:
        pos = at
        try:
            while not tool.eof:
                take = getattr(tool, "unconsumed_tail", b"")
                if not take and getattr(tool, "needs_input", True):
                    take = view[pos : pos + PIECE]
                    pos += len(take)
                out = tool.decompress(take, PIECE)
                if out:
                    yield out
                elif not len(take) and pos >= len(data) and not tool.eof:
                    break
        except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError):
            return
        if not tool.eof:
            end[0] = len(data)
            return
        at = end[0] = pos - len(tool.unused_data)
        while at < len(data) and not data[at]:  # padding between streams
            at += 1


def blocks(data: bytes, at: int, end: list[int]):
    """``unpacked`` content as a whole, or in overlapping blocks of ``MAX_LAYER`` bytes."""
    kept, fresh = bytearray(), 0
    for piece in unpacked(data, at, end):
        kept += piece
        fresh += len(piece)
        while len(kept) > MAX_LAYER:
            yield bytes(kept[:MAX_LAYER])
            del kept[: MAX_LAYER - MAX_LAYER // 8]
            fresh = len(kept) - MAX_LAYER // 8
    if fresh > 0:
        yield bytes(kept)


def readable(data: bytes) -> tuple[str, int] | None:
    """Decoded bytes as a text of one character per byte (or per two), or None for noise."""
    if len(data) >= 8 and not any(data[1::2][: len(data) // 2]) and data[::2].isascii():
        return data[: len(data) // 2 * 2 : 2].decode("latin-1"), 2
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    # the patterns are ASCII, so bytes serve as characters and positions stay exact
    return data.decode("latin-1"), 1


class Layer:
    """A text whose characters know the part of the original they come from."""

    def __init__(self, text: str, starts=None, ends=None, whole: tuple[int, int] | None = None):
        self.text, self.starts, self.ends, self.whole = text, starts, ends, whole

    def root(self, i: int, j: int) -> tuple[int, int]:
        if self.whole is not None:
            return self.whole
        if self.starts is None:
            return i, j
        return int(self.starts[i]), int(self.ends[j - 1])


def escaped(layer: Layer) -> Layer | None:
    """The layer with URL, Unicode and numeric escapes replaced."""
    text, parts, starts, ends, placed = layer.text, [], [], [], layer.whole is None
    last = 0

    def keep(i: int, j: int) -> None:
        if j > i:
            parts.append(text[i:j])
            if placed:
                starts.append(np.arange(i, j))
                ends.append(np.arange(i + 1, j + 1))

    for m in ESCAPE.finditer(text):
        kind, got = m.lastgroup, m.group(m.lastgroup)
        if kind == "pct":
            raw = bytes.fromhex(got.replace("%", ""))
            out = raw.decode("utf-8", "replace")
            width = [3 * max(1, len(c.encode("utf-8"))) if c != "�" else 3 for c in out]
            if sum(width) != m.end() - m.start():
                out, width = raw.decode("latin-1"), [3] * len(raw)
            at = m.start() + np.concatenate([[0], np.cumsum(width)])
            keep(last, m.start())
            parts.append(out)
            starts.append(at[:-1])
            ends.append(at[1:])
        else:
            if kind == "pair":
                code = 0x10000 + ((int(got[2:6], 16) - 0xD800) << 10) + int(got[8:12], 16) - 0xDC00
            else:
                code = int(got, 10 if kind == "dec" else 16)
            if code > 0x10FFFF or 0xD800 <= code < 0xE000:
                continue
            keep(last, m.start())
            parts.append(chr(code))
            starts.append(np.array([m.start()]))
            ends.append(np.array([m.end()]))
        last = m.end()
    if not parts:
        return None
    keep(last, len(text))
    if layer.whole is not None:
        return Layer("".join(parts), whole=layer.whole)
    s, e = np.concatenate(starts), np.concatenate(ends)
    if layer.starts is not None:
        s, e = layer.starts[s], layer.ends[e - 1]
    return Layer("".join(parts), s, e)


def escaped_bytes(layer: Layer):
    """Bytes that a layer's escapes stand for, where packed data may begin, and the part of each range of them."""
    for sign, pattern in BYTES:
        if sign not in layer.text:
            continue
        # one byte a character; characters beyond a byte are not part of packed data
        plain = layer.text.encode("latin-1", "replace")

        def byte(m: re.Match) -> bytes:
            got = m.groupdict()
            if got.get("short"):
                return bytes([SHORT[got["short"][0]]])
            if got.get("name"):
                return NAMES[got["name"]]
            if got.get("dec"):
                return bytes([int(got["dec"])]) if int(got["dec"]) < 256 else b"?"
            return bytes([int(next(g for g in m.groups() if g), 16)])

        for body in (plain, plain.replace(b"+", b" ")) if sign == "%" and b"+" in plain else (plain,):
            data = pattern.sub(byte, body)
            if data == body or not MAGIC.search(data):
                continue
            width = np.ones(len(data), np.int64)
            shift = 0
            for m in pattern.finditer(body):
                width[m.start() - shift] = m.end() - m.start()
                shift += m.end() - m.start() - 1
            ends = np.cumsum(width)
            yield data, lambda i, j, ends=ends, width=width: layer.root(int(ends[i] - width[i]), int(ends[j - 1]))


def encoded(layer: Layer):
    """Base64 runs of a layer in all four alignments: bytes, if the run is in order so, its part of the
    original, and a function that gives for all bytes their first and last character.

    A word before the run, joined by ``/``, ``-`` or ``_``, only shifts it, and one behind it adds noise.
    """
    for m in BASE64.finditer(layer.text):
        run = m.group().rstrip("=")
        clean = run.replace("\r", "").replace("\n", "")
        plain = clean.replace("-", "+").replace("_", "/")
        for shift in range(4):
            n = len(clean) - shift
            n -= n % 4 == 1
            if n < 8:
                continue
            data = base64.b64decode(plain[shift : shift + n] + "=" * (-n % 4))

            def places(shift=shift, n=n, size=len(data)):
                where = np.arange(len(run)) if len(run) == len(clean) else np.array([i for i, c in enumerate(run) if c not in "\r\n"])
                where, byte = m.start() + where[shift : shift + n], np.arange(size)
                first, last = where[byte * 8 // 6], where[np.minimum((byte * 8 + 7) // 6, n - 1)] + 1
                return (first, last) if layer.starts is None else (layer.starts[first], layer.ends[last - 1])

            yield data, shift == 0 and n == len(clean), layer.root(m.start(), m.end()), None if layer.whole is not None else places


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """Base spans, all spans, layers read and layers that were too large, for one text.

    A worklist holds layers still to be read. Every layer is scanned and unwrapped; what comes
    out joins the list unless a layer with the same content from the same part was read before,
    so a packing that yields itself ends.
    """
    base = sorted(base_spans(text))
    spans, work, seen, layers, large = set(base), [Layer(text)], set(), 0, 0

    def add(layer: Layer) -> None:
        at = layer.root(0, len(layer.text)) if layer.text else (0, 0)
        mark = (hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), at)
        if layer.text and mark not in seen:
            seen.add(mark)
            work.append(layer)

    def add_packed(data: bytes, part_of) -> None:
        """Content of every packed stream in the bytes."""
        nonlocal large
        done = 0
        for m in MAGIC.finditer(data):
            if m.start() < done:
                continue
            end = [0]
            content = blocks(data, m.start(), end)
            first = next(content, None)
            if first is None:
                continue
            more = sum(1 for _ in content)  # the end is known when all was read
            done = end[0]
            part = part_of(m.start(), done or len(data))
            again = (hashlib.blake2b(first, digest_size=16).digest(), part, "packed", more)
            if again in seen:
                continue
            seen.add(again)
            if more:
                large += 1
                work.append((blocks(data, m.start(), [0]), part))
            else:
                add_content(first, part)

    def add_content(inner: bytes, part: tuple[int, int]) -> None:
        # what comes out may itself be packed or text of any kind
        add_packed(inner, lambda i, j: part)
        for m in WIDE.finditer(inner):
            add(Layer(m.group()[::2].decode("latin-1"), whole=part))
        add(Layer(inner.decode("latin-1"), whole=part))

    def add_bytes(data: bytes, sure: bool, part: tuple[int, int], places) -> None:
        got = readable(data) if sure and not MAGIC.match(data) else None
        kept = [(*got, 0)] if got else [(data.decode("latin-1"), 1, 0)] if LOOK.search(data) else []
        if not got or got[1] == 1:
            kept += [(m.group()[::2].decode("latin-1"), 2, m.start()) for m in WIDE.finditer(data)]
        magic = MAGIC.search(data)
        if not kept and not magic:
            return
        if places is None:
            add_packed(data, lambda i, j: part)
            for body, _, _ in kept:
                add(Layer(body, whole=part))
            return
        starts, ends = places()
        if magic:
            add_packed(data, lambda i, j: part if (i, j) == (0, len(data)) else (int(starts[i]), int(ends[j - 1])))
        for body, step, at in kept:
            last = at + len(body) * step
            add(Layer(body, starts[at:last:step], ends[at + step - 1 : last : step]))

    while work:
        layer = work.pop()
        if isinstance(layer, tuple):  # content in blocks: one of them is read to its end, then the next
            block = next(layer[0], None)
            if block is not None:
                work.append(layer)
                add_content(block, layer[1])
            continue
        layers += 1
        if layers > 1:
            for i, kind, j in base_spans(layer.text):
                a, b = layer.root(i, j)
                spans.add((a, kind, b))
        if "%" in layer.text or "\\" in layer.text or "&#" in layer.text:
            plain = escaped(layer)
            if plain is not None:
                add(plain)
            for data, part_of in escaped_bytes(layer):
                add_packed(data, part_of)
        for data, sure, part, places in encoded(layer):
            add_bytes(data, sure, part, places)
    return base, sorted(spans), layers, large


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{i}:{j}" for i, k, j in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, overlapping ones as one, replaced by a fixed mark."""
    out, last = [], 0
    for i, _, j in spans:
        if i >= last:
            out += [text[last:i], "[secret]"]
        last = max(last, j)
    return "".join([*out, text[last:]])


def scan_column(text: str, mask: bool = False):
    """Column of the scan of a text column, as a struct (see ``SCHEMA``)."""

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            t = t if isinstance(t, str) else ""
            base, spans, layers, large = scan(t)
            n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            rows.append((*n, digest, joined(spans), len(spans), layers, large, masked(t, spans) if mask and spans else None))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return F.pandas_udf(run, SCHEMA)(F.col(text))


def secret_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its secrets in a struct column ``secrets``.

    The scan is per row: null and empty texts have none, repeated rows give repeated results,
    an empty table gives an empty table, and other columns pass through. ``n_assign, n_access,
    n_hex`` and ``base_sha256`` describe matches of the text itself; ``spans`` also has those of
    decoded layers, each as the part of the text it was decoded from.
    """
    return docs.withColumn("secrets", scan_column(text))


def mask_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the found spans replaced by a mark, and ``n_chars`` (if there) counted anew.

    Rows without secrets, null texts among them, are returned unchanged.
    """
    found = docs.withColumn("_secrets", scan_column(text, mask=True))
    out = found.withColumn(text, F.coalesce("_secrets.masked", F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_secrets.masked").isNotNull(), F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
