"""Secret scan by a worklist of decoded layers.

A text is scanned as it is. Encoded parts are then unwrapped to new layers, which are
scanned and unwrapped in turn until nothing new appears: percent escapes and Unicode
escapes are decoded in place within their line, base64 runs alone, and base64 whose bytes
are gzip, zlib or zstandard data is decompressed. Base64 is of either alphabet and may be
wrapped over lines; a run that is no text as a whole is also opened behind its separators
and in its parts, as a token after a URL path. Packed data written in percent or byte
escapes is decompressed as well: a first piece is inflated before anything is decoded
whole, so a run full of false heads costs linear time. Content is inflated as a stream, through
all gzip members and zstandard frames, and scanned in windows of ``WINDOW_BYTES`` that overlap by
``OVERLAP_BYTES``, so its size costs no memory. Every decoded layer is scanned and unwrapped, whatever its
bytes: as UTF-8, else UTF-16, else Latin-1, and once more without its NULs. A layer seen
before is not entered again,
so chains that lead back to themselves end. Every character of a layer carries the range
of the original text that it came from; a find in a layer is reported as that range, with
the way it was reached (``path``, such as ``base64/url``; empty for the text itself).

Null is the empty text. Finds with equal kind and range are reported once, the text's own
first. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from array import array
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import fresh, slices

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\x[0-9A-Fa-f]{2})+|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
_RUN, _BREAK = r"[A-Za-z0-9+/_-]", r"(?:[\x20\t]*\r?\n[\x20\t]*|(?:\\r)?\\n)"
#: A run of either alphabet with the lines it is wrapped over; a short line is the last and has nothing behind it.
_BASE64 = re.compile(
    rf"{_RUN}{{16,}}(?:{_BREAK}{_RUN}{{16,}})*(?:{_BREAK}{_RUN}{{1,15}}(?==|[\x20\t]*(?:\r?\n|\Z)|\\|[\"']))?={{0,2}}"
)
_LINE = re.compile(_BREAK)
_STANDARD = str.maketrans("-_", "+/")
_SEPARATOR = re.compile(r"[+/_-]+")
#: What may stand alone between separators: either alphabet, what is between slashes, and what is between any.
_PARTS = [re.compile(rf"[A-Za-z0-9{more}]{{16,}}") for more in ("+/", "_-", "+_-", "")]
#: The first base64 characters of gzip, zstandard and zlib data.
_PACKED = re.compile(r"H4sI|KLUv[/_]|e[AFJN]")
#: Heads of packed data in percent escapes and in byte escapes, and what the data may go on with.
_PERCENT_PACKED = re.compile(
    r"(?:(?:%1[Ff]|\x1f)%8[Bb]|(?:%28|\()%[Bb]5(?:%2[Ff]|/)%[Ff][Dd]|(?:%78|x)(?:%01|%5[Ee]|\^|%9[Cc]|%[Dd][Aa]))"
)
_X = r"\\(?:x|u00)"
_ESCAPE_PACKED = re.compile(
    rf"(?:{_X}1[Ff]{_X}8[Bb]|(?:{_X}28|\(){_X}[Bb]5(?:{_X}2[Ff]|/){_X}[Ff][Dd]"
    rf"|(?:{_X}78|x)(?:{_X}01|{_X}5[Ee]|\^|{_X}9[Cc]|{_X}[Dd][Aa]))"
)
_PERCENT_RUN, _ESCAPE_RUN = re.compile(r"[\x21-\x7e]*"), re.compile(r"[\x20-\x7e\x80-\xff]*")
_PERCENT_BYTE = re.compile(r"%([0-9A-Fa-f]{2})|(.)", re.S)
_ESCAPE_BYTE = re.compile(r"\\(?:x|u00)([0-9A-Fa-f]{2})|\\([abtnvfr0\\'\"/])|(.)", re.S)
_SIMPLE = dict(zip("abtnvfr0", b"\a\b\t\n\v\f\r\0"))
_NULS = re.compile("\x00+")
#: Base64 characters that show whether text starts at a place.
_HEAD = 24
#: Content is scanned in windows of so many bytes; two neighbours share the last ones of the first.
WINDOW_BYTES, OVERLAP_BYTES = 8 << 20, 64 << 10
#: Bytes that an inflater is asked for at a time, and characters of a run that are tried first.
CHUNK_BYTES = 1 << 20
PROBE = 64


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the three patterns in one layer."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def _percent(run: str) -> str:
    return bytes.fromhex(run.replace("%", "")).decode("utf-8", "replace")


def _escape(run: str) -> str:
    if run[:2] == "&#":
        code = int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])
    elif run[:3] == "\\u{":
        code = int(run[3:-1], 16)
    elif run[:2] == "\\U":
        code = int(run[2:], 16)
    elif run[:2] == "\\x":
        return bytes.fromhex(run.replace("\\x", "")).decode("latin-1")
    else:
        units = bytes.fromhex(run.replace("\\u", ""))
        return units.decode("utf-16-be", "replace")
    return chr(code) if code < 0xD800 or 0xDFFF < code <= 0x10FFFF else "�"


class _Bytes:
    """Bytes, and then those of a stream, read in pieces."""

    def __init__(self, head: bytes, source=None):
        self.head, self.at, self.source = head, 0, source

    def read(self, size: int) -> bytes:
        if self.at >= len(self.head) and self.source is not None:
            self.head, self.at = self.source.read(CHUNK_BYTES), 0
        made = self.head[self.at : self.at + size]
        self.at += len(made)
        return made


class _Inflater:
    """The content of gzip, zlib or zstandard data, through all gzip members or zstandard frames, as a stream
    that ends where the data ends or errs. ``used``: bytes of ``data`` up to the end of the last whole one."""

    def __init__(self, data: _Bytes, kind: str):
        self.data, self.kind, self.used, self.left, self.ended = data, kind, 0, b"", False
        self.stream = self._stream()

    def _stream(self):
        if self.kind == "zstd":
            import zstandard

            return zstandard.ZstdDecompressor().decompressobj()
        return zlib.decompressobj(31 if self.kind == "gzip" else 15)

    def _step(self, size: int) -> bytes:
        """Some content, or none if there is more to read first."""
        if self.kind == "zstd":  # a few bytes may stand for a megabyte
            more = self.left or self.data.read(PROBE)
            made = self.stream.decompress(more) if more else b""
            self.left = b""
        else:
            more = self.stream.unconsumed_tail or self.left or self.data.read(4096)
            self.left = b"" if not self.stream.unconsumed_tail else self.left
            made = self.stream.decompress(more, size) if more else b""
        self.ended = not more
        if self.stream.eof:
            self.used = self.data.at - len(self.stream.unused_data)
            self.left = self.stream.unused_data + self.data.read(4)
            if _kind(self.left) == self.kind != "zlib":
                self.stream = self._stream()
            else:
                self.ended = True
        return made

    def read(self, size: int = CHUNK_BYTES) -> bytes:
        made = b""
        while not made and not self.ended:
            try:
                made = self._step(size)
            except zlib.error:
                self.ended = True
            except Exception as e:  # zstandard's own error type
                if type(e).__name__ != "ZstdError":
                    raise
                self.ended = True
        return made


def _kind(head: bytes) -> str | None:
    """The packing that bytes begin with."""
    if head[:2] == b"\x1f\x8b":
        return "gzip"
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return "zlib"
    return "zstd" if head[:4] == b"\x28\xb5\x2f\xfd" else None


def _plausible(data: bytes) -> bool:
    """Whether bytes begin with packed data, the first part of which has no error."""
    kind = _kind(data)
    if kind is None:
        return False
    stream = _Inflater(_Bytes(data), kind).stream
    try:
        stream.decompress(data[: 4 * PROBE], *(() if kind == "zstd" else (CHUNK_BYTES,)))
    except zlib.error:
        return False
    except Exception as e:  # zstandard's own error type
        if type(e).__name__ != "ZstdError":
            raise
        return False
    return True


def _content(data: bytes) -> tuple[object, int] | None:
    """(stream of what packed data holds at its innermost, how often it was packed), None for anything else."""
    source, head, depth, met = None, data, 0, set()
    while head not in met and _plausible(head):  # content that is its own packing is met again
        met.add(head)
        stream = _Inflater(_Bytes(head, source), _kind(head))
        first = stream.read()
        if not first:
            break
        source, head, depth = stream, first, depth + 1
    return (_Again(head, source), depth) if depth else None


class _Again:
    """A stream whose first bytes were read already."""

    def __init__(self, head: bytes, source):
        self.head, self.source = head, source

    def windows(self):
        """The content in windows that overlap."""
        made = bytearray(self.head)
        while True:
            more = self.source.read(CHUNK_BYTES)
            made += more or b""
            if not more or len(made) >= WINDOW_BYTES:
                yield bytes(made)
                if not more:
                    return
                del made[: len(made) - OVERLAP_BYTES]


def _length(data: bytes) -> int:
    """Bytes of packed data up to the end of its outermost packing; all of it if that has no end."""
    stream = _Inflater(_Bytes(data), _kind(data))
    while not stream.ended:
        stream.read()
    return stream.used or len(data)


def _wide(data: bytes) -> str | None:
    """The UTF-16 that data is written in by its mark or by where its zeros are, None for another encoding."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16-le" if data[0] == 0xFF else "utf-16-be"
    even, odd = data[::2].count(0), data[1::2].count(0)
    if max(even, odd) * 4 < len(data) // 2 or min(even, odd) * 8 > max(even, odd) or len(data) < 4:
        return None
    return "utf-16-le" if odd > even else "utf-16-be"


def _decoded(data: bytes) -> tuple[str, str]:
    """Text of any bytes, and its encoding."""
    code = _wide(data)
    if code:
        return data[: len(data) // 2 * 2].decode(code, "replace"), code
    try:
        return data.decode("utf-8"), "utf-8"
    except UnicodeDecodeError:
        return data.decode("latin-1"), "latin-1"


def _clear(text: str, code: str) -> bool:
    """Whether bytes are text and no noise, so that a run needs no opening in parts."""
    return code != "latin-1" and bool(text) and all(c >= " " or c in "\t\n\r" for c in text) and "\ufffd" not in text


def _percent_bytes(run: str) -> tuple[bytes, list[int]]:
    """Bytes of a text in percent escapes and the places that they come from."""
    found = list(_PERCENT_BYTE.finditer(run))
    return bytes(int(m[1], 16) if m[1] else ord(m[2]) for m in found), [m.start() for m in found]


def _escape_bytes(run: str) -> tuple[bytes, list[int]]:
    """Bytes of a text in byte escapes and the places that they come from."""
    found = list(_ESCAPE_BYTE.finditer(run))
    made = (int(m[1], 16) if m[1] else _SIMPLE.get(m[2], ord(m[2])) if m[2] else ord(m[3]) for m in found)
    return bytes(made), [m.start() for m in found]


def _width(c: str, code: str) -> int:
    """Bytes of a character in an encoding."""
    if code != "utf-8":
        return 1 if code == "latin-1" else 2 if c < "\U00010000" else 4
    return 1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4


def _unbase64(run: str) -> bytes:
    core = run.rstrip("=").translate(_STANDARD)
    core = core[: len(core) - (len(core) % 4 == 1)]
    return base64.b64decode(core + "=" * (-len(core) % 4))


def _starts(core: str) -> list[int]:
    """Places behind separators from which a run that is no text as a whole is opened: those of
    packed data, and for each alignment the first that text starts at."""
    made, aligned = [], set()
    for m in _SEPARATOR.finditer(core):
        for at in range(m.start() + 1, m.end() + 1):
            if len(core) - at < 16:
                return made
            head = _unbase64(core[at : at + _HEAD])
            if _PACKED.match(core, at) and _plausible(head):
                made.append(at)
            elif at % 4 not in aligned and any(_clear(*_decoded(head[:n])) for n in range(len(head), len(head) - 4, -1)):
                aligned.add(at % 4)
                made.append(at)
    return made


def _wrapped(lines: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Lines that follow each other, in groups of equal length up to a shorter one."""
    groups: list[list[tuple[int, int]]] = []
    width, closed = 0, True
    for a, b in lines:
        if closed or b - a > width:
            groups.append([])
            width, closed = b - a, False
        groups[-1].append((a, b))
        closed = b - a < width
    return groups


class _Layer:
    """A decoded text; ``spans`` maps its characters to ranges of the original: None for the original
    itself, one (start, end) that all characters share, or arrays of their starts and ends."""

    __slots__ = ("path", "spans", "text")

    def __init__(self, text, spans, path):
        self.text, self.spans, self.path = text, spans, path

    def original(self, start: int, end: int) -> tuple[int, int]:
        if self.spans is None:
            return start, end
        if isinstance(self.spans, tuple):
            return self.spans
        return min(self.spans[0][start:end]), max(self.spans[1][start:end])

    def key(self) -> tuple:
        """Equal for layers that give the same finds."""
        where = self.spans if self.spans is None or isinstance(self.spans, tuple) else (self.spans[0][:1].tolist(), self.spans[1][-1:].tolist())
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), str(where)

    def lines_with(self, pattern, hint: str):
        """(start, end) of the lines in which ``pattern`` occurs."""
        if hint not in self.text:
            return
        last = -1
        for m in pattern.finditer(self.text):
            if m.start() < last:
                continue
            start = self.text.rfind("\n", 0, m.start()) + 1
            end = self.text.find("\n", m.end())
            last = len(self.text) if end < 0 else end
            yield start, last

    def rewritten(self, start: int, end: int, pattern, decode, name: str) -> _Layer:
        """The part from ``start`` to ``end`` with every match of ``pattern`` decoded in place."""
        text, at, path = [], start, f"{self.path}/{name}".strip("/")
        if isinstance(self.spans, tuple):
            return _Layer(pattern.sub(lambda m: decode(m[0]), self.text[start:end]), self.spans, path)
        starts, ends = array("q"), array("q")

        def as_is(a: int, b: int) -> None:
            text.append(self.text[a:b])
            if self.spans is None:
                starts.extend(range(a, b))
                ends.extend(range(a + 1, b + 1))
            else:
                starts.extend(self.spans[0][a:b])
                ends.extend(self.spans[1][a:b])

        for m in pattern.finditer(self.text, start, end):
            as_is(at, m.start())
            made, (whole_a, whole_b) = decode(m[0]), self.original(m.start(), m.end())
            step, rest = divmod(m.end() - m.start(), max(1, len(made)))
            for i in range(len(made)):  # equal parts: one escape a character
                a = m.start() + i * step
                own = (whole_a, whole_b) if rest else self.original(a, a + step)
                starts.append(own[0])
                ends.append(own[1])
            text.append(made)
            at = m.end()
        as_is(at, end)
        return _Layer("".join(text), [starts, ends], path)

    def children(self):
        for start, end in self.lines_with(_PERCENT, "%"):
            yield self.rewritten(start, end, _PERCENT, _percent, "url")
        for hint in ("\\", "&#"):
            if hint in self.text:
                for start, end in self.lines_with(_ESCAPE, hint):
                    yield self.rewritten(start, end, _ESCAPE, _escape, "unicode")
                break
        if "%" in self.text:
            yield from self.unpacked(_PERCENT_PACKED, _PERCENT_RUN, _percent_bytes, "url")
        if "\\" in self.text:
            yield from self.unpacked(_ESCAPE_PACKED, _ESCAPE_RUN, _escape_bytes, "unicode")
        for start, end in self.lines_with(_NULS, "\x00"):
            yield self.rewritten(start, end, _NULS, lambda run: "", "nul")
        for m in _BASE64.finditer(self.text):
            yield from self.unwrapped(m.start(), m.end())

    def unwrapped(self, start: int, end: int):
        """Layers of a base64 run and the lines it is wrapped over. What is text or packed data
        as a whole is not opened in parts."""
        lines, at = [], start
        for m in _LINE.finditer(self.text, start, end):
            lines.append((at, m.start()))
            at = m.end()
        lines.append((at, end))
        groups, clear = _wrapped(lines), set()
        for group in [*(g for g in groups if len(g) > 1), *([lines] if len(groups) > 1 else [])]:
            if not clear.issuperset(group):
                made, whole = self.opened(group)
                clear.update(group if whole else ())
                yield from made
        for a, b in lines:
            if (a, b) in clear:
                continue
            made, whole = self.opened([(a, b)])
            yield from made
            if whole:
                continue
            run = self.text[a:b].rstrip("=")
            places = {(a + at, b) for at in _starts(run)}
            places |= {(a + m.start(), a + m.end()) for part in _PARTS for m in part.finditer(run)} - {(a, a + len(run))}
            for place in sorted(places):
                yield from self.opened([place])[0]

    def windows(self, stream, where: tuple[int, int], path: str):
        """Layers of the windows of a stream."""
        for window in stream.windows():
            yield _Layer(_decoded(window)[0], where, path)

    def opened(self, pieces: list[tuple[int, int]]):
        """Layers of a base64 run that lies in ``pieces``, and whether it is text or packed data as a whole. A
        character of packed data has all pieces for its range, another one those that it lies in."""
        data = _unbase64("".join(self.text[a:b] for a, b in pieces))
        whole, path = self.original(pieces[0][0], pieces[-1][1]), f"{self.path}/base64".strip("/")
        if (found := _content(data)) is not None:
            return self.windows(found[0], whole, path + "/compressed" * found[1]), True
        text, code = _decoded(data)
        spans = whole
        if len(pieces) > 1:
            own = [self.original(a, b) for a, b in pieces]
            begins = list(accumulate((b - a for a, b in pieces[:-1]), initial=0))
            at, spans = 0, [array("q"), array("q")]
            for c in text:
                first, at = at, at + _width(c, code)
                j, k = bisect_right(begins, first * 4 // 3) - 1, bisect_right(begins, (at * 8 - 1) // 6) - 1
                spans[0].append(min(x for x, _ in own[j : k + 1]))
                spans[1].append(max(y for _, y in own[j : k + 1]))
        return iter([_Layer(text, spans, path)]), _clear(text, code)

    def unpacked(self, heads, run, read, name: str):
        """Layers of packed data that is written in escapes. A head's run is decoded in pieces that grow, as long
        as they inflate without an error, so a false head costs a few characters."""
        at, false = 0, set()
        while (m := heads.search(self.text, at)) is not None:
            at, end, size = m.start() + 1, None, PROBE
            if self.text[m.start() : m.start() + size] in false:
                continue
            while True:
                piece = self.text[m.start() : m.start() + size]
                here = run.match(piece).end()
                whole = here < len(piece) or m.start() + size >= len(self.text)
                if not whole:  # without what may be half an escape
                    cut = max(piece.rfind("\\", here - 6), piece.rfind("%", here - 3))
                    here = cut if cut > 0 else here
                data, places = read(piece[:here])
                if whole:
                    end = m.start() + here
                    break
                if not _plausible(data):
                    if size == PROBE and len(false) < 4096:
                        false.add(piece)
                    break
                size *= 8
            if end is None or not _plausible(data) or (found := _content(data)) is None:
                continue
            used = _length(data)
            at = end if used >= len(data) else m.start() + places[used]
            where, path = self.original(m.start(), at), f"{self.path}/{name}".strip("/") + "/compressed" * found[1]
            yield from self.windows(found[0], where, path)


def find_secrets(text: str | None) -> list[tuple[str, int, int, str]]:
    """All (kind, start, end, path) of a text and the layers under it, by start, kind and end."""
    found: dict[tuple[str, int, int], str] = {}
    # a layer is opened when its turn comes, so that only those on the way down are held
    seen, work = set(), [iter([_Layer(text or "", None, "")])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        key = layer.key()
        if key in seen:
            continue
        seen.add(key)
        for kind, start, end in scan(layer.text):
            found.setdefault((kind, *layer.original(start, end)), layer.path)
        work.append(layer.children())
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(((*k, p) for k, p in found.items()), key=lambda s: (s[1], order[s[0]], s[2]))


SPAN = "array<struct<kind:string,start:int,end:int,path:string>>"
_ARROW_SPAN = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("path", pa.string())])
)


def with_secrets(df: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``df`` plus ``out``: array of (kind, start, end, path). A column of that name is replaced."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    schema = StructType([f for f in df.schema.fields if f.name != out]).add(out, _parse_datatype_string(SPAN))
    names = [f.name for f in schema.fields[:-1]]
    keys = ("kind", "start", "end", "path")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                rows = [[dict(zip(keys, s)) for s in find_secrets(t)] for t in part.column(text_col).to_pylist()]
                made = pa.array(rows, _ARROW_SPAN)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [made], names + [out])

    return df.mapInArrow(run, schema)


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every found range of ``text_col`` replaced by ``mark``; overlapping ranges are one.
    Null stays null."""
    whole, spans = fresh(df, "whole"), fresh(df, "spans")
    made = with_secrets(df.withColumn(whole, F.col(f"`{text_col}`").cast("string")), whole, spans)

    def step(acc, s):
        """Ranges come by start: (text so far, end of the last range) after one more."""
        part = F.col(whole).substr(acc["upto"] + 1, s["start"] - acc["upto"])
        new = F.struct(F.concat(acc["done"], part, F.lit(mark)).alias("done"), s["end"].alias("upto"))
        old = F.struct(acc["done"].alias("done"), F.greatest(acc["upto"], s["end"]).alias("upto"))
        return F.when(s["start"] >= acc["upto"], new).otherwise(old)

    fold = F.aggregate(
        F.col(spans), F.struct(F.lit("").alias("done"), F.lit(0).alias("upto")), step,
        lambda acc: F.concat(acc["done"], F.col(whole).substr(acc["upto"] + 1, F.length(whole))),
    )
    clean = F.when(F.size(spans) == 0, F.col(whole)).otherwise(fold)
    return made.withColumn(text_col, clean).drop(whole, spans)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of the text's own finds by kind, their SHA-256, and all finds as text."""
    own = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    base = F.filter("secrets", lambda s: s["path"] == "")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return with_secrets(own).select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
