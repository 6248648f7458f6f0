"""Secret scans: decode nested layers until nothing new appears, scan each, map spans back."""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import itertools
import lzma
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flakeform.llm.common import release_kept

#: Fixed patterns, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
MIN_VALUE = 6
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_PLAIN_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9a-f]+")
#: Two or more lines of base64 that follow each other, indented or not.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
#: Characters of inflated text that are scanned at once, and how many of them the next block repeats.
BLOCK, OVERLAP = 1 << 22, 1 << 16

#: What tokens and values are made of.
_TOKEN_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=%-"
#: Rounds of escapes whose layers are each scanned; deeper ones are decoded at once.
ROUNDS = 4

Span = tuple[int, int, str]


class _Same:
    """A list of one number repeated, without its memory."""

    def __init__(self, value: int, size: int):
        self.value, self.size = value, size

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at: int | slice) -> int | _Same:
        return _Same(self.value, len(range(*at.indices(self.size)))) if isinstance(at, slice) else self.value

    def __iter__(self) -> Iterator[int]:
        return itertools.repeat(self.value, self.size)


@dataclass(frozen=True)
class Layer:
    """A decoded text. Character i came from characters ``starts[i]`` up to ``ends[i]`` of the input.

    ``depth``: rounds of escapes that were decoded in place since the text or token it began with.
    """

    text: str
    starts: list[int] | range | _Same
    ends: list[int] | range | _Same
    depth: int = 0

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if isinstance(self.starts, _Same):
            return self.starts.value, self.ends.value
        return min(self.starts[start:end]), max(self.ends[start:end])


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the plain secrets, by start, then kind as listed."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(start, end, KINDS[kind]) for start, end, kind in sorted(found, key=lambda x: (x[0], x[2]))]


def _readable(text: str) -> bool:
    """Not mostly control characters and bytes that are no text."""
    if text.isprintable() and "\ufffd" not in text:
        return bool(text)
    odd = sum(c == "\ufffd" or unicodedata.category(c) == "Cc" and c not in "\r\n\t" for c in text)
    return 2 * odd < len(text)


def _encoding(head: bytes) -> str:
    """UTF-16 where a byte order mark or the zero bytes of plain letters tell it, otherwise UTF-8."""
    if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16-le" if head[0] == 0xFF else "utf-16-be"
    some = head[:4096]
    if len(some) >= 8:
        for name, zeros, others in (("utf-16-le", some[1::2], some[::2]), ("utf-16-be", some[::2], some[1::2])):
            if 4 * zeros.count(0) >= 3 * len(zeros) and others.count(0) * 4 <= len(others):
                return name
    return "utf-8"


def _characters(data: bytes) -> tuple[str, list[int]] | None:
    """Text that is not mostly control characters, and the byte at which each character begins.

    Bytes that are no text become U+FFFD each time, and do not keep the others from being read.
    """
    encoding = _encoding(data)
    wide = encoding != "utf-8"
    bad: dict[int, int] = {}

    def note(error: UnicodeError) -> tuple[str, int]:
        bad[error.start] = error.end
        return "\ufffd", error.end

    codecs.register_error("flakeform-note", note)
    text = data.decode(encoding, "flakeform-note")
    if not _readable(text):
        return None
    if not wide and text.isascii():
        return text, list(range(len(text) + 1))
    places, at = [], 0
    for c in text:
        places.append(at)
        at = bad[at] if c == "\ufffd" and at in bad else at + len(c.encode(encoding))
    return text, [*places, at]


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The whole layer with each match decoded in place; None if nothing changes."""
    text, starts, ends, at = [], [], [], 0
    same = isinstance(layer.starts, _Same)

    def copy(a: int, b: int) -> None:
        text.append(layer.text[a:b])
        if not same:
            starts.extend(layer.starts[a:b])
            ends.extend(layer.ends[a:b])

    for m in pattern.finditer(layer.text):
        if (got := decode(m[0])) is not None:
            new, places = got
            copy(at, m.start())
            text.append(new)
            for i in range(0 if same else len(new)):
                a, b = layer.origin(m.start() + places[i], m.start() + places[i + 1])
                starts.append(a)
                ends.append(b)
            at = m.end()
    if not at:
        return None
    copy(at, len(layer.text))
    new, depth = "".join(text), layer.depth + 1
    if same:
        return Layer(new, _Same(layer.starts.value, len(new)), _Same(layer.ends.value, len(new)), depth)
    return Layer(new, starts, ends, depth)


def _url(token: str) -> tuple[str, list[int]] | None:
    got = _characters(bytes.fromhex(token.replace("%", "")))
    return got and (got[0], [3 * x for x in got[1]])


def _escape(token: str) -> tuple[str, list[int]] | None:
    if token[0] == "&":
        code = int(token[3:-1], 16) if token[2] == "x" else int(token[2:-1])
    else:
        code = int(token[2:], 16)
    if code > 0x10FFFF or 0xD800 <= code <= 0xDFFF or not code:
        return None
    return chr(code), [0, len(token)]


def _first(text: str) -> tuple[str, int] | None:
    """What the escape at the beginning of a text stands for, and its length; None if there is none."""
    if text[0] != "%":
        found = _UNICODE.match(text)
        got = found and _escape(found[0])
        return got and (got[0], found.end())
    found = _URL.match(text)
    data = bytes.fromhex(found[0].replace("%", "")) if found else b"\x80"
    size = 1 if data[0] < 0x80 else 2 if data[0] < 0xE0 else 3 if data[0] < 0xF0 else 4
    try:
        char = data[:size].decode()
    except UnicodeDecodeError:
        return None
    return (char, 3 * size) if _readable(char) else None


def _settled(layer: Layer) -> Layer | None:
    """The layer with every escape decoded in place, and what that gives decoded again, until none is left.

    One pass from the end: what stands to the right of a character is settled already, so a decoded ``%`` or ``&`` is only
    looked at with the few characters after it. The time is that of one layer, however deep escapes are nested.
    """
    same = isinstance(layer.starts, _Same)
    chars: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    changed = False
    for i in range(len(layer.text) - 1, -1, -1):
        chars.append(layer.text[i])
        starts.append(layer.starts[i])
        ends.append(layer.ends[i])
        while chars[-1] in "%\\&" and (got := _first("".join(chars[:-13:-1]))):
            new, used = got
            a, b = min(starts[-used:]), max(ends[-used:])
            del chars[-used:], starts[-used:], ends[-used:]
            chars.append(new)
            starts.append(a)
            ends.append(b)
            changed = True
    if not changed:
        return None
    text = "".join(reversed(chars))
    if same:
        return Layer(text, _Same(layer.starts.value, len(text)), _Same(layer.ends.value, len(text)))
    return Layer(text, starts[::-1], ends[::-1])


class _Zlib:
    """zlib and gzip data with the interface of the other decompressors."""

    def __init__(self) -> None:
        self.machine, self.rest = zlib.decompressobj(47), b""

    def decompress(self, data: bytes, most: int) -> bytes:
        out = self.machine.decompress(self.rest + data, most)
        self.rest = self.machine.unconsumed_tail
        return out

    @property
    def needs_input(self) -> bool:
        return not self.rest

    @property
    def eof(self) -> bool:
        return self.machine.eof

    @property
    def unused_data(self) -> bytes:
        return self.machine.unused_data


def _machine(head: bytes) -> _Zlib | bz2.BZ2Decompressor | lzma.LZMADecompressor | None:
    """Decompressor of gzip, zlib, bz2 or xz data, told by its first bytes."""
    if head[:2] == b"\x1f\x8b" or head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2]) % 31 == 0:
        return _Zlib()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if head[:6] == b"\xfd7zXZ\x00" else None


def _members(chunks: Iterator[bytes], left: list[bytes] | None = None) -> Iterator[bytes]:
    """What all members of compressed data give, in pieces; up to the first error or what is no member: ``left`` gets that."""
    data = b""
    while True:
        while len(data) < 6 and (more := next(chunks, None)) is not None:
            data += more
        if (machine := _machine(data)) is None:
            # Members of xz data may be padded.
            if data and not data.strip(b"\0"):
                data = b""
                continue
            if data[:1] == b"\0" and _machine(data.lstrip(b"\0")):
                data = data.lstrip(b"\0")
                continue
            if left is not None:
                left.append(data)
            return
        while not machine.eof:
            if not data and machine.needs_input and (data := next(chunks, None)) is None:
                return
            try:
                out = machine.decompress(data, BLOCK)
            except (zlib.error, OSError, lzma.LZMAError, ValueError, EOFError):
                return
            data = b""
            if out:
                yield out
        data = machine.unused_data


def _used(data: bytes) -> int:
    """Bytes that the members of compressed data take."""
    left: list[bytes] = []
    for _ in _members(iter([data]), left):
        pass
    return len(data) - sum(map(len, left)) or len(data)


def _inflated(data: bytes) -> Iterator[bytes] | None:
    """Pieces of what compressed data holds, archives in archives opened until none is left; None for other data."""
    seen: set[bytes] = set()
    stream, head, opened = iter(()), data, False
    while _machine(head):
        # An archive that holds itself ends here.
        if (key := hashlib.sha256(head).digest()) in seen:
            return iter(())
        seen.add(key)
        inner = _members(itertools.chain([head], stream))
        parts, size = [], 0
        while size < BLOCK and (piece := next(inner, None)) is not None:
            parts.append(piece)
            size += len(piece)
        if not parts:
            break
        # A small archive is held as a whole, so that many layers do not call each other.
        stream, head, opened = inner if size >= BLOCK else iter(()), b"".join(parts), True
    return itertools.chain([head], stream) if opened else None


def _texts(pieces: Iterator[bytes]) -> Iterator[str]:
    """Readable text of the pieces in overlapping blocks. A token that a block cuts is whole in the next one, if a block holds it."""
    first = next(pieces, b"")
    decoder = codecs.getincrementaldecoder(_encoding(first))("replace")
    held, new = "", 0
    for piece in itertools.chain([first], pieces):
        text = decoder.decode(piece)
        held, new = held + text, new + len(text)
        while len(held) >= BLOCK:
            if _readable(held[:BLOCK]):
                yield held[:BLOCK]
            begin = len(held[:BLOCK].rstrip(_TOKEN_CHARACTERS)) or BLOCK
            held, new = held[min(begin, BLOCK - OVERLAP) :], len(held) - BLOCK
    text = decoder.decode(b"", True)
    held, new = held + text, new + len(text)
    if new and _readable(held):
        yield held


def _wrapped(text: str) -> Iterator[list[tuple[int, int]]]:
    """Places of the lines of wrapped base64, as lists of (start, end).

    Lines of one width belong together, with the shorter one after them, and with the one before, which may start
    amid a line. As words of the text around look like base64 too, each choice is given.
    """
    for m in _WRAPPED.finditer(text):
        lines = [(x.start(), x.end()) for x in _LINE.finditer(text, m.start(), m.end())]
        given, at = set(), 0
        while at < len(lines):
            width, to = lines[at][1] - lines[at][0], at + 1
            while to < len(lines) and lines[to][1] - lines[to][0] == width:
                to += 1
            if width >= 16:
                for a, b in itertools.product((at, max(0, at - 1)), (to, min(len(lines), to + 1))):
                    if b - a > 1 and (a, b) not in given:
                        given.add((a, b))
                        yield lines[a:b]
            at = to


def _base64(body: str) -> bytes | None:
    try:
        return base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _tokens(layer: Layer) -> Iterator[Layer]:
    """Layers inside base64 tokens, compressed or plain, also of those wrapped into lines."""
    for m in _BASE64.finditer(layer.text):
        body = m[0].rstrip("=")
        if _PLAIN_WORD.fullmatch(body) and len(body) < 24 or len(body) % 4 == 1:
            continue
        if data := _base64(body):
            yield from _opened(layer, data, range(m.start(), m.end()), m.end())
    if "\n" in layer.text:
        for lines in _wrapped(layer.text):
            body = "".join(layer.text[a:b] for a, b in lines)
            body = body[: len(body) - (len(body) % 4 == 1)]
            if data := _base64(body):
                # Words after compressed data are no part of it.
                used = _used(data) if _machine(data) else len(data)
                places = [i for a, b in lines for i in range(a, b)]
                places = places[: -(-used * 4 // 3)] if used < len(data) else places
                end = places[-1] + 1
                while layer.text[end : end + 1] == "=" and end < places[-1] + 3:
                    end += 1
                yield from _opened(layer, data[:used], places, end)


def _opened(layer: Layer, data: bytes, at: range | list[int], end: int) -> Iterator[Layer]:
    """Layers of decoded base64, whose characters are ``at`` these places of the layer; padding ends at ``end``."""
    if (pieces := _inflated(data)) is not None:
        a, b = layer.origin(at[0], end)
        for text in _texts(pieces):
            yield Layer(text, _Same(a, len(text)), _Same(b, len(text)))
    if got := _characters(data):
        text, places = got
        if isinstance(layer.starts, _Same):
            yield Layer(text, _Same(layer.starts.value, len(text)), _Same(layer.ends.value, len(text)))
            return
        starts, ends = [], []
        for i in range(len(text)):
            a = at[places[i] * 4 // 3]
            b = end if i == len(text) - 1 else at[-(-places[i + 1] * 4 // 3) - 1] + 1
            a, b = layer.origin(a, b)
            starts.append(a)
            ends.append(b)
        yield Layer(text, starts, ends)


def all_spans(text: str, base: list[Span] | None = None) -> list[Span]:
    """Base spans and those of every decoded layer, as spans of the given text, each once.

    A worklist of layers: each is scanned, then its URL escapes, Unicode escapes and base64 tokens
    (compressed ones inflated, in overlapping blocks of ``BLOCK`` characters) give further layers. A layer seen before, at the same origin, is not
    entered again, so the list runs dry: every step makes the text shorter or inflates it once. Escapes nested deeper than
    ``ROUNDS`` are decoded to the end in one pass, whose result is scanned; so time does not grow with their depth.
    """
    found = set(base_spans(text) if base is None else base)
    seen: set[bytes] = set()
    # Layers are drawn as they are needed: of a long inflated text one block at a time is held.
    work: list[Iterator[Layer]] = [iter([Layer(text, range(len(text)), range(1, len(text) + 1))])]
    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
            continue
        key = hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest()
        key += b"%d,%d" % (layer.starts[0], layer.ends[-1]) if layer.text else b""
        if key in seen:
            continue
        seen.add(key)
        if len(seen) > 1:
            found |= {(*layer.origin(start, end), kind) for start, end, kind in base_spans(layer.text)}
        if layer.depth >= ROUNDS:
            if new := _settled(layer):
                work.append(iter([new]))
        else:
            if "%" in layer.text and (new := _replaced(layer, _URL, _url)):
                work.append(iter([new]))
            if ("\\" in layer.text or "&#" in layer.text) and (new := _replaced(layer, _UNICODE, _escape)):
                work.append(iter([new]))
        work.append(_tokens(layer))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``spans`` as arrays of (kind, start, end).

    Offsets are code points, the end exclusive. ``base`` has the plain secrets; ``spans`` adds those
    of decoded layers. Null text counts as empty and has none. Repeated rows stay, ties by start go
    by kind as listed. Other columns of the input are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            base, every = [], []
            for text in batch.column("text").to_pylist():
                plain = base_spans(text or "")
                base.append(plain)
                every.append(all_spans(text or "", plain))
            rows = [
                pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in x] for x in spans], span)
                for spans in (base, every)
            ]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), *rows], ["doc_id", "base", "spans"])

    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        scan, f"doc_id bigint, base {span}, spans {span}"
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with every span of the text replaced by ``[kind]``; overlapping spans become one.

    ``n_chars``, where the table has it, is set anew for changed texts. Null text stays null.
    """
    columns = docs.columns

    def clean(value: str) -> str:
        out, at = [], 0
        for start, end, kind in all_spans(value):
            if start >= at:
                out += [value[at:start], f"[{kind}]"]
            at = max(at, end)
        return "".join([*out, value[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for batch in batches:
            old = batch.column(text).to_pylist()
            new = [x and clean(x) for x in old]
            place = batch.schema.get_field_index(text)
            batch = batch.set_column(place, batch.schema.field(place), pa.array(new, batch.schema.field(place).type))
            if "n_chars" in columns:
                place = batch.schema.get_field_index("n_chars")
                kept = batch.column(place).to_pylist()
                sizes = [k if a == b else len(b) for k, a, b in zip(kept, old, new, strict=True)]
                field = batch.schema.field(place)
                batch = batch.set_column(place, field, pa.array(sizes, field.type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
