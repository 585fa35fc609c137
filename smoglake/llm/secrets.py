"""Secret scan: pattern search through nested encodings.

A worklist starts with the text itself. Each layer is searched for secrets,
then unwrapped: percent escapes, Unicode escapes and character references
are decoded over the whole layer; base64 runs are decoded one by one, and
compressed bytes found there (gzip, zlib, bzip2, xz, zstandard) are
expanded. Every new layer joins the worklist until none is left (fixpoint).
A layer equal to one of its own ancestors is a cycle and is dropped. Each
layer carries, for every character, the stretch of the original text it came
from, so a finding in any layer is reported as a span of the original.

Defined results: a null text is an empty one; repeated rows are scanned row
by row; an empty table gives an empty table. Texts are scanned whole. Base64 is
decoded from each of the four places of a run, so a prefix glued to it does not
matter; lines of any one width, indented or not, are one run. Bytes that are no
UTF-8 text are searched for stretches of plain text, as single bytes and
as UTF-16. Compressed streams are found anywhere in the decoded bytes, several
one after another too; a damaged one is read as far as it goes. Expanded bytes
come in overlapping windows of ``MAX_LAYER_BYTES``; a stream within a stream is
followed within a window. Only a stream that expands beyond
``MAX_EXPANDED_BYTES`` is cut off there and counted in ``n_oversize``.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG, STRING, field, load_documents, map_columns

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the same as [0-9a-f]+ with the short ones dropped

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
ESCAPE = re.compile(r"\\[uUx]([0-9A-Fa-f]{8}|[0-9A-Fa-f]{4}|[0-9A-Fa-f]{2})|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
SHORTEST_RUN = 16
BASE64_LINES = re.compile(r"[A-Za-z0-9+/_-]{8,}={0,2}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+={0,2}(?=[^ \t\w]|[ \t]*\r?\n|[ \t]*\Z))*")
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
LEAST = 12  # characters of the shortest finding
STRETCH = re.compile(rb"[\x20-\x7e\t\n\r]{12,}")
WIDE = re.compile(rb"(?:[\x20-\x7e\t\n\r]\x00){11,}[\x20-\x7e\t\n\r]")
MAX_LAYER_BYTES = 64 << 20  # of a window of expanded bytes
OVERLAP = 1 << 20
MAX_EXPANDED_BYTES = 1 << 30  # of one stream: a guard against blocks that expand without end
RETRIES = 16


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets in one layer, leftmost and non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class Layer:
    """A text, where each of its characters came from, and the digests of the layers around it."""

    def __init__(self, text: str, starts: np.ndarray | None, ends: np.ndarray | None, above: frozenset):
        self.text, self.starts, self.ends, self.above = text, starts, ends, above

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def key(self) -> tuple[bytes, bytes]:
        """Tells layers apart by text and origins."""
        if self.starts is None:
            where = b""
        elif self.starts.strides == (0,) and self.ends.strides == (0,):  # one span for all of an expanded text
            where = f"{self.starts[0]}:{self.ends[0]}".encode()
        else:
            where = np.stack([self.starts, self.ends]).astype(np.int64).tobytes()
        return _digest(self.text), hashlib.blake2b(where, digest_size=16).digest()

    def inner(self, text: str, starts: np.ndarray, ends: np.ndarray) -> Layer | None:
        """A layer below this one; none if it repeats this one or one above."""
        around = self.above | {_digest(self.text)}
        return None if _digest(text) in around else Layer(text, starts, ends, around)


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _replace(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The whole layer with each match of ``pattern`` decoded; unmatched text keeps its place."""
    parts, starts, ends, at = [], [], [], 0
    n = len(layer.text)
    own_starts = np.arange(n) if layer.starts is None else layer.starts
    own_ends = np.arange(1, n + 1) if layer.ends is None else layer.ends
    for m in pattern.finditer(layer.text):
        made = decode(m[0])
        low, high = layer.origin(m.start(), m.end())
        parts += [layer.text[at:m.start()], made]
        starts += [own_starts[at:m.start()], np.full(len(made), low)]
        ends += [own_ends[at:m.start()], np.full(len(made), high)]
        at = m.end()
    if not parts:
        return None
    return layer.inner("".join([*parts, layer.text[at:]]), np.concatenate([*starts, own_starts[at:]]),
                       np.concatenate([*ends, own_ends[at:]]))


def _percent(run: str) -> str:
    return bytes.fromhex(run.replace("%", "")).decode("utf-8", "replace")


def _escapes(run: str) -> str:
    codes = [int(a or c, 16) if a or c else int(b) for a, b, c in ESCAPE.findall(run)]
    units = "".join(chr(c) if c < 0x110000 else "�" for c in codes)
    return units.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _worker(data: bytes, at: int):
    """(decompressor for the stream that starts at ``at``, bytes to feed at a time), or None."""
    head = data[at:at + 6]
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31), 1 << 16
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor(), 1 << 16
    if head == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(), 1 << 16
    if head[:4] == b"\x28\xb5\x2f\xfd":
        import zstandard
        return zstandard.ZstdDecompressor().decompressobj(), 256  # it takes no output bound: a block of 128 KB may be 4 bytes
    if len(head) > 2 and head[0] & 15 == 8 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj(), 1 << 16
    return None


def inflate(data: bytes, at: int) -> Iterator[tuple[bytes, int, bool]]:
    """(piece, place reached, whether the stream ended there) of the stream at ``at``; a damaged one as far as it goes."""
    made = _worker(data, at)
    if made is None:
        return
    worker, step = made
    while at < len(data):
        feed = data[at:at + step]
        at += len(feed)
        while True:
            try:
                piece = worker.decompress(feed) if step == 256 else worker.decompress(feed, 1 << 20)
            except Exception:  # noqa: BLE001  damaged streams raise each codec's own errors
                yield b"", at, False
                return
            if worker.eof:
                yield piece, at - len(worker.unused_data), True
                return
            yield piece, at, False
            feed = getattr(worker, "unconsumed_tail", b"")
            if not feed and getattr(worker, "needs_input", True) and len(piece) < 1 << 20:
                break


def streams(data: bytes) -> tuple[list[tuple[bytes, int, int]], int]:
    """(window of what a compressed stream in ``data`` expands to, first and last place of the stream), streams cut off.

    A stream may start anywhere; the search goes on behind one that was whole and one place further
    where it was not. Long ones come in overlapping windows. Starts that read on and break off
    all over the block may read it ``RETRIES`` times; then the search goes on behind them too.
    """
    out, oversize, at, spent = [], 0, 0, 0
    first = _worker(data, 0) is not None
    while True:
        if not first:
            m = MAGIC.search(data, at)
            if m is None:
                return out, oversize
            at = m.start()
        first = False
        held, size, end, whole, windows, last = [], 0, at, False, [], b""
        total = 0
        for piece, end, whole in inflate(data, at):
            held.append(piece)
            size += len(piece)
            total += len(piece)
            if size >= MAX_LAYER_BYTES:
                window = b"".join(held)
                if window != last:
                    windows.append(window)
                last, held, size = window, [window[-OVERLAP:]], OVERLAP
                if total >= MAX_EXPANDED_BYTES:
                    oversize += 1
                    break
        windows.append(b"".join(held))
        out += [(w, at, end) for w in windows if len(w) >= LEAST]
        if not whole:
            spent += end - at
        at = end if whole or spent > RETRIES * len(data) else at + 1


def texts(data: bytes) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(text, first byte and byte behind of each character) of the texts in decoded bytes.

    Bytes that are UTF-8 text are one text. Of others, the stretches of plain ASCII are taken, as single bytes and
    as UTF-16: every pattern and every encoding is plain ASCII, so none lies across their ends.
    """
    out = []
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        text = ""
    if text and (text.isprintable() or sum(c.isprintable() or c in "\t\n\r" for c in text) >= 0.9 * len(text)):
        at = np.arange(len(data) + 1) if text.isascii() else np.cumsum([0, *[len(c.encode()) for c in text]])
        out.append((text, at[:-1], at[1:]))
    else:
        for m in STRETCH.finditer(data):
            at = np.arange(m.start(), m.end())
            out.append((m[0].decode("ascii"), at, at + 1))
    if b"\0" in data:
        for m in WIDE.finditer(data):
            at = np.arange(m.start(), m.end(), 2)
            out.append((m[0][::2].decode("ascii"), at, at + 1))
    return out


def _runs(text: str) -> list[tuple[str, np.ndarray]]:
    """(characters, their places) of each base64 run; lines of one width, indented or not, are joined with the next shorter one."""
    out: list[tuple[str, np.ndarray]] = []
    for block in BASE64_LINES.finditer(text):
        width, closed = 0, True
        for m in BASE64_RUN.finditer(text, block.start(), block.end()):
            run = m[0].rstrip("=")
            places = np.arange(m.start(), m.start() + len(run))
            if not closed and len(run) <= width:
                out[-1][0].append(run)
                out[-1][1].append(places)
                closed = len(run) < width
            else:
                out.append(([run], [places]))
                width, closed = len(run), False
            closed = closed or m[0] != run
    return [("".join(r), np.concatenate(p)) for r, p in out if sum(map(len, r)) >= SHORTEST_RUN]


def _packed(data: bytes, low: int, high: int, layer: Layer) -> tuple[list[Layer], int]:
    """Layers of all texts in expanded bytes, and in the streams within them; nothing finer than the block's span is known."""
    made, work, seen, oversize = [], [data], set(), 0
    while work:
        data = work.pop()
        digest = hashlib.blake2b(data, digest_size=16).digest()
        if digest in seen:
            continue
        seen.add(digest)
        for text, _, _ in texts(data):
            made.append(layer.inner(text, np.broadcast_to(low, len(text)), np.broadcast_to(high, len(text))))
        windows, too_large = streams(data)
        oversize += too_large
        work += [w for w, _, _ in windows]
    return [x for x in made if x is not None], oversize


def _base64(layer: Layer) -> tuple[list[Layer], int]:
    """Layers below the base64 runs of a layer. A run may be glued to a prefix, so it is decoded from each of four places."""
    made, oversize = [], 0
    for run, all_places in _runs(layer.text):
        alphabet = b"-_" if "-" in run or "_" in run else None
        for offset in range(4):
            part, places = run[offset:], all_places[offset:]
            part = part[:-1] if len(part) % 4 == 1 else part
            data = base64.b64decode(part + "=" * (-len(part) % 4), altchars=alphabet)
            for text, first, behind in texts(data):
                # a byte came from the characters that hold its eight bits
                start, end = places[first * 8 // 6], places[(behind * 8 - 1) // 6]
                made.append(layer.inner(text, start if layer.starts is None else layer.starts[start],
                                        end + 1 if layer.ends is None else layer.ends[end]))
            windows, too_large = streams(data)
            oversize += too_large
            for window, start, end in windows:
                low, high = layer.origin(int(places[start * 8 // 6]), int(places[(end * 8 - 1) // 6]) + 1)
                below, too_large = _packed(window, low, high, layer)
                made += below
                oversize += too_large
    return [x for x in made if x is not None], oversize


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """(spans of the text itself, spans with those of all layers, layers below, blocks too large)."""
    text = text or ""
    base = find(text)
    spans, n_layers, oversize = set(base), 0, 0
    work, seen = [Layer(text, None, None, frozenset())], set()
    while work:
        layer = work.pop()
        if layer.key() in seen:  # reached in another order of decoding: same text, same origins
            continue
        seen.add(layer.key())
        if layer.starts is not None:
            n_layers += 1
            for start, kind, end in find(layer.text):
                low, high = layer.origin(start, end)
                spans.add((low, kind, high))
        below, too_large = _base64(layer)
        oversize += too_large
        if "%" in layer.text:
            below.append(_replace(layer, PERCENT, _percent))
        if "\\" in layer.text or "&#" in layer.text:
            below.append(_replace(layer, ESCAPES, _escapes))
        work += [x for x in below if x is not None]
    return base, sorted(spans), n_layers, oversize


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, base counts and digest, all spans, layers and oversize blocks. One map, no shuffle."""
    def run(texts):
        rows = []
        for text in texts:
            base, spans, n_layers, oversize = scan(text)
            rows.append((*[sum(k == i for _, k, _ in base) for i in range(3)],
                         hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), n_layers, oversize))
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(7)]

    made = [field(f"n_{k}", LONG) for k in KINDS] + [field("base_sha256", STRING), field("spans", STRING),
                                                     field("n_layers", LONG), field("n_oversize", LONG)]
    return map_columns(docs, [text_col], made, run, [id_col])


def redacted(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with every span (merged where they overlap) replaced by ``mark``."""
    if not text:
        return text
    spans = scan(text)[1]
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced in the text and the length column brought up to date. All rows stay."""
    columns = docs.columns
    rest = [c for c in columns if c != text_col]
    new = "redacted"
    while new in columns:
        new += "_"
    out = map_columns(docs, [text_col], [field(new, STRING)], lambda texts: [[redacted(t) for t in texts]], rest)
    out = out.withColumnRenamed(new, text_col)
    if length_col in columns:
        out = out.withColumn(length_col, F.char_length(F.col(f"`{text_col}`")).cast(docs.schema[length_col].dataType))
    return out.select(*[f"`{c}`" for c in columns])


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document, through all layers."""
    return scan_documents(load_documents(spark, sf_dir))
