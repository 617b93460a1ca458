"""Secrets in texts, also inside nested encodings.

Three kinds are looked for: assignments (a name such as ``token``, a sign, a value), access
keys and long hex strings. The base scan reads the text as it stands. Then a worklist
unwraps what is encoded: stretches of base64 and of hex digits, compressed streams, and whole
layers with URL, quoted-printable, HTML, Unicode, octal or string escapes. Each new layer is
scanned and unwrapped in turn until nothing new comes out; a layer seen before is not opened
again, which also ends cycles. A stretch of base64 is read at all four alignments, one of hex
digits at both, and compressed streams are looked for anywhere in any layer, as a stretch may
begin or end with characters of the text around it. Neighbouring lines of equal width are also
read as one stretch.
A layer knows by rule where its bytes came from in the one around it, so that what is found in
any layer is reported as a span of the original text. A compressed body maps as a whole.

Rules: null and empty texts have no spans; repeated rows are scanned each. A compressed body is
read to its end, in overlapping blocks of ``INFLATED`` bytes, so that a worker holds a few times
that and a few times the text, however much a body inflates to and however deep bodies nest.
Base64, hex digits and streams inside a body that are longer than the overlap and cross a block's
end are read from where they begin, in blocks too; of escapes inside them, the blocks are read.
Very long texts are read whole. Other columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from html.entities import html5
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardmart.llm.common import freeing

KINDS = ("assign", "access", "hex")
#: Bytes of a compressed body that are looked at as one.
INFLATED = 1 << 23
#: Bytes that numpy looks at in one go.
CHUNK = 1 << 20
#: Shortest stretches of base64 and of hex digits that are opened: ``STRETCH`` bytes.
BASE64 = 16
HEX = 24
#: Shortest secret: a name of five letters, a sign and a value of six characters.
STRETCH = 12
#: Bytes of a compressed stream that are read in one go, and most of its body where that can be set.
FED = 1 << 12
FED_OUT = 1 << 20
#: Bytes that two blocks of a compressed body share.
OVERLAP = 1 << 20

_ASSIGN = re.compile(
    rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_NAMES = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_NEXT_LINE = re.compile(rb"[\x20\t]*(?:\r\n?|\n)[\x20\t>*#]*([A-Za-z0-9+/_-]+)")
_NEXT_HEX_LINE = re.compile(rb"[\x20\t]*(?:\r\n?|\n)[\x20\t>*#]*([0-9A-Fa-f]+)")
_PERCENT = re.compile(rb"%([0-9A-Fa-f]{2})")
# A sign at a line's end joins it with the next.
_QUOTED = re.compile(rb"=(?:([0-9A-F]{2})|[\x20\t]*(?:\r\n?|\n))")


def scan(data: bytes) -> list[tuple[int, int, str]]:
    """Start, end and kind of each secret in one layer, as byte offsets."""
    found = []
    lower = data.lower()
    if any(n in lower for n in _NAMES):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(data)
                  if m.end(1) - m.start(1) >= 6]
    if b"AKIA" in data:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(data)
                  if m.end() - m.start() >= 20]
    found += [(s, e, "hex") for s, e in long_runs(data)]
    return found


#: Whether a byte is 0-9 or a-f, or a hex digit of either case; whether it belongs to base64.
_IS_HEX = np.zeros(256, bool)
_IS_HEX[list(b"0123456789abcdef")] = True
_IS_DIGIT = _IS_HEX.copy()
_IS_DIGIT[list(b"ABCDEF")] = True
_IS_64 = np.zeros(256, bool)
_IS_64[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True

#: Whether a byte ends a line.
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(b"\r\n")] = True

#: Whether a byte is a plain character: printable ASCII, tab or a line's end.
_IS_PLAIN = np.zeros(256, bool)
_IS_PLAIN[[9, 10, 13, *range(32, 127)]] = True


def _each_run(data: bytes, member: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Stretches of ``least`` or more bytes of a class, chunk by chunk; one may span several."""
    view, opened = np.frombuffer(data, np.uint8), None
    for at in range(0, len(view), CHUNK):
        inside = member[view[at:at + CHUNK]].view(np.int8)
        edges = np.flatnonzero(np.diff(inside, prepend=np.int8(opened is not None))) + at
        if opened is not None:
            edges = np.append(opened, edges)
        opened = int(edges[-1]) if len(edges) % 2 else None
        start, end = edges[:len(edges) - len(edges) % 2].reshape(-1, 2).T
        long = end - start >= least
        yield from zip(start[long].tolist(), end[long].tolist())
    if opened is not None and len(data) - opened >= least:
        yield opened, len(data)


def _runs(data: bytes, member: np.ndarray, least: int) -> list[tuple[int, int]]:
    return list(_each_run(data, member, least))


def long_runs(data: bytes, least: int = 24) -> list[tuple[int, int]]:
    return _runs(data, _IS_HEX, least)


Place = Callable[[int], int]


class Layer:
    """Bytes, and where each of them starts and ends in the layer around it; places rise."""

    def __init__(self, data: bytes, around: Layer | None = None, first: Place = lambda i: i,
                 last: Place = lambda i: i + 1):
        self.data, self.around, self.first, self.last = data, around, first, last

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The bytes of the original text that a stretch comes from."""
        layer = self
        while layer is not None:
            start, end, layer = layer.first(start), layer.last(end - 1), layer.around
        return start, end


def _holds_text(data: bytes) -> bool:
    """Whether decoded bytes hold a stretch of plain characters in which a secret has room.

    Secrets and the encodings they hide in consist of such characters only, so whatever else
    lies around the stretch (bytes of a prefix, marks, other scripts) does not matter.
    """
    return next(_each_run(data, _IS_PLAIN, STRETCH), None) is not None


_HEADERS = re.compile(
    rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")


def _is_worth(data: bytes) -> bool:
    """Whether decoded bytes may hold a secret or a compressed stream."""
    return _holds_text(data) or _HEADERS.search(data) is not None


def _stream(data: memoryview):
    """A reader of the compressed stream that ``data`` begins with, and how much to feed it at once."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31), FED
    if data[:1] == b"\x78":
        return zlib.decompressobj(), FED
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor(), FED
    if data[:1] == b"\xfd":
        return lzma.LZMADecompressor(), FED
    import zstandard

    # Its output cannot be limited: a block of 128 KB takes 4 bytes at least.
    return zstandard.ZstdDecompressor().decompressobj(), FED // 16


def _pieces(data: memoryview) -> Iterator[tuple[bytes, int]]:
    """The body of the compressed stream that ``data`` begins with, as far as it can be read, some
    bytes at a time, and how many bytes of ``data`` were read for them."""
    used = 0
    try:
        stream, fed = _stream(data)
        limited = () if fed < FED else (FED_OUT,)
        while used < len(data) and not stream.eof:
            more, used = data[used:used + fed], min(used + fed, len(data))
            while True:
                out = stream.decompress(more, *limited)
                if stream.eof:
                    used -= len(stream.unused_data)
                yield out, used
                more = getattr(stream, "unconsumed_tail", b"")
                if stream.eof or not limited or not (more or len(out) == FED_OUT):
                    break
    except Exception:  # noqa: BLE001 - cut short, or not a stream of that kind after all
        pass


def _inflated(data: memoryview) -> Iterator[tuple[bytes, int]]:
    """The body of the compressed stream that ``data`` begins with, in blocks of about ``INFLATED``
    bytes that overlap by ``OVERLAP``, and for each how many bytes of ``data`` the stream has.

    A body of several blocks is read once more, to find its end, and from each long stretch in it
    that crosses a block's end.
    """
    end = None
    for block in _blocks(lambda: (out for out, _ in _pieces(data))):
        if end is None:
            end = max(read for _, read in _pieces(data))
        yield block, end


Chunks = Callable[[], Iterator[bytes]]


def _blocks(body: Chunks) -> Iterator[bytes]:
    """``body`` in overlapping blocks, each followed by those of the stretches that are decoded
    from it and that no block holds whole."""
    parts, size, at = [], 0, 0
    new = False  # whether there is more than the overlap
    for out in body():
        if out:
            parts.append(out)
            size, new = size + len(out), True
        if size >= INFLATED:
            whole = b"".join(parts)
            parts, new = [whole[-OVERLAP:]], False
            size = len(parts[0])
            yield whole
            for inner in _crossing(body, whole, at):
                yield from _blocks(inner)
            at += len(whole) - size
    if new:
        yield b"".join(parts)


def _crossing(body: Chunks, block: bytes, at: int) -> Iterator[Chunks]:
    """What is encoded in ``body`` from a place of ``block`` on, which begins at ``at``, to beyond
    the block's end. What begins in the overlap is left to the next block."""
    before = len(block) - OVERLAP
    for member, width, decode in ((_IS_64, 4, _from_64), (_IS_DIGIT, 2, _from_digits)):
        inside = member | _IS_BREAK
        start = next((s for s, e in _each_run(block, inside, OVERLAP) if e == len(block)), None)
        # One from the block's first byte on began earlier, unless the body does.
        if start is not None and (start or not at):
            for skip in range(width):
                yield lambda start=start, inside=inside, width=width, decode=decode, skip=skip: _decoded_chunks(
                    _from(body, at + start), inside, width, decode, skip)
    for m in _HEADERS.finditer(block, 0, before):
        read = 0
        for _, read in _pieces(memoryview(block)[m.start():]):
            pass
        if read == len(block) - m.start():
            yield lambda start=m.start(): _inflated_chunks(_from(body, at + start))


def _from(body: Chunks, at: int) -> Iterator[bytes]:
    """``body`` from a place on."""
    for chunk in body():
        if at < len(chunk):
            yield chunk[at:]
        at = max(0, at - len(chunk))


def _decoded_chunks(chunks: Iterator[bytes], inside: np.ndarray, width: int,
                    decode: Callable[[bytes, int], bytes], skip: int) -> Iterator[bytes]:
    """What the first stretch of a class holds from its character ``skip`` on; line ends do not count."""
    rest = b""
    for chunk in chunks:
        outside = np.flatnonzero(~inside[np.frombuffer(chunk, np.uint8)])
        run = chunk[:outside[0]] if len(outside) else chunk
        run = run.translate(_STANDARD, b"\r\n")
        skip, run = max(0, skip - len(run)), rest + run[skip:]
        whole = len(run) // width * width
        rest = run[whole:]
        yield decode(run[:whole], 0)
        if len(outside):
            break
    yield decode(rest, 0)


def _inflated_chunks(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The body of the compressed stream that begins with the first of ``chunks``."""
    head = b""
    try:
        for chunk in chunks:
            head += chunk
            if len(head) >= 8:
                break
        stream, fed = _stream(memoryview(head))
        limited = () if fed < FED else (FED_OUT,)
        for chunk in chain([head], chunks):
            for i in range(0, len(chunk), fed):
                more = chunk[i:i + fed]
                while True:
                    out = stream.decompress(more, *limited)
                    yield out
                    more = getattr(stream, "unconsumed_tail", b"")
                    if stream.eof or not limited or not (more or len(out) == FED_OUT):
                        break
                if stream.eof:
                    return
    except Exception:  # noqa: BLE001 - cut short, or not a stream of that kind after all
        pass


def _whole(layer: Layer, start: int, end: int, body: bytes) -> Layer:
    return Layer(body, layer, lambda _: start, lambda _: end)


def _from_streams(layer: Layer) -> Iterator[Layer]:
    """The bodies of compressed streams, wherever they begin in the layer."""
    for m in _HEADERS.finditer(layer.data):
        for inner, used in _inflated(memoryview(layer.data)[m.start():]):
            if _is_worth(inner):
                yield _whole(layer, m.start(), m.start() + used, inner)


def _from_base64(layer: Layer) -> Iterator[Layer]:
    data = layer.data
    for start, end in _each_run(data, _IS_64, BASE64):
        yield from _decoded(layer, data[start:end], start.__add__)
    for lines in _wrapped(data, _IS_64, BASE64, _NEXT_LINE):
        yield from _decoded(layer, *_joined(data, lines))


def _from_hex(layer: Layer) -> Iterator[Layer]:
    data = layer.data
    for start, end in _each_run(data, _IS_DIGIT, HEX):
        yield from _of_digits(layer, data[start:end], start.__add__)
    for lines in _wrapped(data, _IS_DIGIT, HEX, _NEXT_HEX_LINE):
        yield from _of_digits(layer, *_joined(data, lines))


def _of_digits(layer: Layer, run: bytes, place: Place) -> Iterator[Layer]:
    """What hex digits hold of which the i-th lies at ``place(i)``, from the first and from the second."""
    for skip in range(2):
        body = _from_digits(run, skip)
        if _is_worth(body):
            yield Layer(body, layer, lambda i, skip=skip: place(skip + 2 * i),
                        lambda i, skip=skip: place(skip + 2 * i + 1) + 1)


def _joined(data: bytes, lines: list[tuple[int, int]]) -> tuple[bytes, Place]:
    """Some lines as one stretch, and where each of its characters lies."""
    starts = [s for s, _ in lines]
    ahead = np.cumsum([0, *(e - s for s, e in lines)]).tolist()

    def place(i: int) -> int:
        line = bisect_right(ahead, i) - 1
        return starts[line] + i - ahead[line]

    return b"".join(data[s:e] for s, e in lines), place


def _wrapped(data: bytes, member: np.ndarray, least: int,
             next_line: re.Pattern) -> Iterator[list[tuple[int, int]]]:
    """Neighbouring lines of a class that may be one body: of equal width, but that the first may
    follow other text on its line and the last may be shorter.

    Each line is also opened by itself, as lines may as well be bodies of their own.
    """
    if b"\n" not in data and b"\r" not in data:
        return
    done = 0
    for start, end in _runs(data, member, least):
        if start < done:
            continue
        lines = [(start, end)]
        while m := next_line.match(data, lines[-1][1]):
            width, new = lines[-1][1] - lines[-1][0], m.end(1) - m.start(1)
            if new > width and len(lines) > 1:
                break
            lines.append(m.span(1))
            if new < width and len(lines) > 2:
                break
        if len(lines) > 1:
            # The last line of one body may be the first of the next.
            done = lines[-1][0]
            yield lines


def _from_digits(run: bytes, skip: int) -> bytes:
    return binascii.unhexlify(memoryview(run)[skip:skip + (len(run) - skip) // 2 * 2])


def _from_64(run: bytes, skip: int) -> bytes:
    """What the characters from ``skip`` on hold; one that completes no byte is left out."""
    whole = skip + (len(run) - skip) // 4 * 4
    tail = run[whole:]
    body = base64.b64decode(memoryview(run)[skip:whole])
    return body + base64.b64decode(tail + b"=" * (-len(tail) % 4)) if len(tail) > 1 else body


def _decoded(layer: Layer, run: bytes, place: Place) -> Iterator[Layer]:
    """What base64 characters hold of which the i-th lies at ``place(i)`` of ``layer``, at every alignment.

    The stretch may begin and end with characters that do not belong to it, as after "key-",
    "/api/v1/" or before "/next". They decode to noise of their own; the rest comes out right at
    one of four alignments.
    """
    run = run.translate(_STANDARD) if b"-" in run or b"_" in run else run
    for skip in range(4):
        body = _from_64(run, skip)
        if _is_worth(body):
            yield Layer(body, layer, lambda i, skip=skip: place(skip + i * 8 // 6),
                        lambda i, skip=skip: place(skip + ((i + 1) * 8 - 1) // 6) + 1)


_STANDARD = bytes.maketrans(b"-_", b"+/")


def _replaced(layer: Layer, pattern: re.Pattern, value) -> Layer | None:
    """The layer with every match of ``pattern`` replaced by its value."""
    out, at, data = bytearray(), 0, layer.data
    # Of each replacement: where it stands, how long it is, and what it replaces.
    stands, size, low, high = array("Q"), array("B"), array("Q"), array("Q")
    for m in pattern.finditer(data):
        new = value(m)
        if new is None:
            continue
        out += data[at:m.start()]
        stands.append(len(out))
        size.append(len(new))
        low.append(m.start())
        high.append(m.end())
        out += new
        at = m.end()
    if not stands:
        return None
    out += data[at:]

    def first(i: int) -> int:
        k = bisect_right(stands, i) - 1
        if k < 0:
            return i
        past = i - stands[k] - size[k]
        return low[k] if past < 0 else high[k] + past

    def last(i: int) -> int:
        k = bisect_right(stands, i) - 1
        if k < 0:
            return i + 1
        past = i - stands[k] - size[k]
        return high[k] if past < 0 else high[k] + past + 1

    return Layer(bytes(out), layer, first, last)


# One escape at a time, so that each maps to its own characters; halves stay together.
_ESCAPES = re.compile(
    rb"\\u[Dd][89ABab][0-9A-Fa-f]{2}\\u[Dd][C-Fc-f][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}"
    rb"|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
    rb"|\\([0-3][0-7]{2})|\\([\"'\\/nrt])|&([A-Za-z][A-Za-z0-9]{1,30};)")
_SIGNS = {b"n": b"\n", b"r": b"\r", b"t": b"\t"}


def _escape(m: re.Match) -> bytes | None:
    raw, code = m[0], m[1] or m[2] or m[3]
    try:
        if code or m[4]:
            return chr(int(code, 16) if code else int(m[4])).encode()
        if m[5]:
            return bytes([int(m[5], 8)])
        if m[6]:
            return _SIGNS.get(m[6], m[6])
        if m[7]:
            named = html5.get(m[7].decode())
            return None if named is None else named.encode()
        if raw[:2] == b"\\x":
            return bytes([int(raw[2:], 16)])
        return bytes.fromhex(raw.replace(b"\\u", b"").decode()).decode("utf-16-be").encode()
    except (ValueError, OverflowError, UnicodeError):
        return None


def unwrapped(layer: Layer) -> Iterator[Layer]:
    """The layers one step further in."""
    data = layer.data
    if b"%" in data:
        inner = _replaced(layer, _PERCENT, lambda m: bytes([int(m[1], 16)]))
        if inner:
            yield inner
    if b"=" in data:
        inner = _replaced(layer, _QUOTED, lambda m: bytes([int(m[1], 16)]) if m[1] else b"")
        if inner:
            yield inner
    if b"\\" in data or b"&" in data:
        inner = _replaced(layer, _ESCAPES, _escape)
        if inner:
            yield inner
    yield from _from_hex(layer)
    yield from _from_base64(layer)
    yield from _from_streams(layer)


def spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans of a text, in characters, by start and then kind."""
    data = text.encode("utf-8", "surrogatepass")
    base = scan(data)
    found = set(base)
    seen = {hashlib.sha256(data).digest()}
    # Depth first, one layer of each depth at a time.
    work = [unwrapped(Layer(data))]
    while work:
        inner = next(work[-1], None)
        if inner is None:
            work.pop()
            continue
        if not inner.data:
            continue
        mark = hashlib.sha256(inner.data)
        mark.update(b"%d:%d" % inner.span(0, len(inner.data)))
        key = mark.digest()
        if key in seen:
            continue
        seen.add(key)
        found.update((*inner.span(s, e), kind) for s, e, kind in scan(inner.data))
        work.append(unwrapped(inner))
    if not found:
        return [], []
    # A span that ends inside a character takes it whole.
    before = _characters(data, sorted({p for s, e, _ in found for p in (s + 1, e)}))

    def characters(some):
        out = {(before[s + 1] - 1, before[e], k) for s, e, k in some}
        return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))

    return characters(base), characters(found)


def _characters(data: bytes, places: list[int]) -> dict[int, int]:
    """How many characters begin before each of some rising byte offsets."""
    view, out, at, total = np.frombuffer(data, np.uint8), {}, 0, 0
    for place in places:
        while at < place:
            end = min(place, at + CHUNK)
            total += int(np.count_nonzero((view[at:end] & 0xC0) != 0x80))
            at = end
        out[place] = total
    return out


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
FIELDS = ("base array<struct<start:long,end:long,kind:string>>, "
          "spans array<struct<start:long,end:long,kind:string>>")


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, text, and its ``base`` and all ``spans`` as arrays of start, end and kind."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(t or "") for t in batch.column("text").to_pylist()]
            lists = [pa.array([[dict(zip(("start", "end", "kind"), s)) for s in row[i]]
                               for row in found], _SPAN) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), *lists],
                names=["doc_id", "text", "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string, {FIELDS}")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the characters of every span replaced by ``[secret]``; overlaps once."""
    schema = docs.schema

    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                parts, at, covered = [], 0, 0
                for start, end, _ in spans(text)[1] if text else ():
                    if start >= covered:
                        parts += [text[at:start], "[secret]"]
                    covered = at = max(covered, end)
                out.append("".join([*parts, text[at:]]) if parts else text)
            where = batch.schema.get_field_index("text")
            yield batch.set_column(where, batch.schema.field(where), pa.array(out, pa.string()))

    return docs.mapInArrow(run, schema)
