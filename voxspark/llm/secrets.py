"""Secrets in texts, also under nested encodings.

A worklist starts with the text itself. Every layer is scanned; URL escapes,
Unicode escapes, base64 runs and compressed bytes at any place in it are
unwrapped to new layers until nothing new comes up. Base64 is joined over line
ends and read at each of its four offsets; of bytes that are not text all
through, every readable stretch is a layer. A layer that was met before, over
the same place, is not opened again, which ends cycles. Every layer knows for
each of its characters the place in the source text, so a finding in any layer
is a span of the source.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from voxspark.llm.common import id_and_text, per_slice

KINDS = ("assign", "access", "hex")
# Letters in either case means A-Z and a-z, hence the ASCII flag.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("passw", "secret", "token", "api")

_URL = re.compile(r"%[0-9A-Fa-f]{2}")
_URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# a line end, plain or written as an escape, and the blanks of the next line
_BREAK = re.compile(r"(?:\r?\n|(?:\\r)?\\n)[\x20\t]*")
_WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:{_BREAK.pattern}[A-Za-z0-9+/_-]++)+={{0,2}}")
_MAGIC = re.compile(rb"\x1f\x8b|\x78[\x01\x5e\x9c\xda]|BZh|\xfd7zXZ\x00")
# ways to write bytes in a text: pattern of the escapes, and what one stands for
_PLAIN_ESCAPES = {"n": 10, "r": 13, "t": 9, "\\": 92, "'": 39, '"': 34, "0": 0, "a": 7, "b": 8, "f": 12, "v": 11}
_HEX_ESCAPE = r"\\x([0-9A-Fa-f]{2})|\\u00([0-9A-Fa-f]{2})|\\u\{0*([0-9A-Fa-f]{1,2})\}|\\U000000([0-9A-Fa-f]{2})"
_BYTE_FORMS = [
    ("%", re.compile(r"%([0-9A-Fa-f]{2})")), ("%", re.compile(r"%([0-9A-Fa-f]{2})|(\+)")),
    ("\\", re.compile(_HEX_ESCAPE)), ("\\", re.compile(_HEX_ESCAPE + r"""|\\([nrt\\'"0abfv])""")),
]
#: No finding, and no layer that holds one, is shorter.
_SHORTEST = 12
_STRETCH = re.compile(
    rb"(?:[\x09-\x0d\x20-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){%d,}" % _SHORTEST)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """kind, start, end of the plain findings in ``text``, in order."""
    low = text.lower()
    found = []
    if any(name in low for name in _NAMES):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return in_order(found)


def in_order(spans) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def inflate(raw: bytes, start: int, most: int) -> tuple[bytes, int] | None:
    """Content and end of the gzip, zlib, bzip2 or xz streams at ``start``.

    Streams of a kind that follow each other are one content. None if there is
    none, the first is broken or cut, or the content is over ``most`` bytes.
    """
    out, at = b"", start
    while True:
        try:
            if raw.startswith(b"BZh", at):
                box = bz2.BZ2Decompressor()
            elif raw.startswith(b"\xfd7zXZ", at):
                box = lzma.LZMADecompressor(memlimit=1 << 26)
            else:
                box = zlib.decompressobj(47)
            part = box.decompress(memoryview(raw)[at:], most - len(out) + 1)
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            part = None
        if part is not None and len(out) + len(part) > most:
            return None
        if part is None or not box.eof:
            return (out, at) if at > start else None
        out, at = out + part, len(raw) - len(box.unused_data)
        if raw[at : at + 2] != raw[start : start + 2]:
            return out, at


class Layer:
    """A text with the start and end, in the source, of each of its characters."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray):
        self.text, self.starts, self.ends = text, starts, ends

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.starts[a:b].min()), int(self.ends[a:b].max())


def _rewritten(layer: Layer, parts: list[tuple[int, int, str]]) -> Layer:
    """``layer`` with each (a, b, text) part replaced; all other characters keep their place."""
    text, starts, ends, at = [], [], [], 0
    for a, b, new in parts:
        text += [layer.text[at:a], new]
        lo, hi = layer.source(a, b)
        starts += [layer.starts[at:a], np.full(len(new), lo, np.int64)]
        ends += [layer.ends[at:a], np.full(len(new), hi, np.int64)]
        at = b
    text.append(layer.text[at:])
    return Layer("".join(text), np.concatenate([*starts, layer.starts[at:]]), np.concatenate([*ends, layer.ends[at:]]))


def _url(layer: Layer):
    if not _URL.search(layer.text):
        return
    parts = []
    for m in _URL_RUN.finditer(layer.text):
        raw, at = bytes.fromhex(m[0].replace("%", "")), m.start()
        for char, n in _utf8_chars(raw):
            parts.append((at, at + 3 * n, char))
            at += 3 * n
    yield _rewritten(layer, parts)


def _utf8_chars(raw: bytes):
    """Each character with its number of bytes; a byte that is not UTF-8 stands for itself."""
    i = 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                yield raw[i : i + n].decode("utf-8"), len(raw[i : i + n])
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            yield chr(raw[i]), 1
            i += 1


def _unicode(layer: Layer):
    parts, pending = [], None
    for m in _UNICODE.finditer(layer.text):
        code = int(next(g for g in m.groups() if g), 16)
        if pending and 0xDC00 <= code < 0xE000 and pending[1] == m.start():
            parts.append((pending[0], m.end(), chr(0x10000 + ((pending[2] - 0xD800) << 10) + code - 0xDC00)))
            pending = None
        elif 0xD800 <= code < 0xDC00:
            pending = (m.start(), m.end(), code)
        elif code < 0x110000 and not 0xDC00 <= code < 0xE000:
            parts.append((*m.span(), chr(code)))
    if parts:
        yield _rewritten(layer, parts)


def _opened(raw: bytes, place, most: int, text_too: bool = True):
    """Layers of the readable stretches of ``raw``, and of all compressed content at any place in it.

    ``place`` gives the source starts and ends of the bytes from a to b. The
    stretches of ``raw`` itself are left out unless ``text_too``.
    """
    work = [(raw, place, text_too, frozenset())]
    while work:
        raw, place, text_too, met = work.pop()
        for m in _STRETCH.finditer(raw) if text_too else ():
            text, (starts, ends) = m[0].decode("utf-8"), place(*m.span())
            last = np.cumsum(np.fromiter((len(c.encode("utf-8")) for c in text), np.int64, len(text))) - 1
            yield Layer(text, starts[np.append(0, last[:-1] + 1)], ends[last])
        at = 0
        while m := _MAGIC.search(raw, at):
            at = m.start() + 1
            found = inflate(raw, m.start(), most)
            if found is None:
                continue
            content, at = found
            mark = hashlib.blake2b(content).digest()
            if mark not in met:  # else content that unpacks to itself
                work.append((content, _whole(*place(m.start(), at)), True, met | {mark}))


def _whole(starts: np.ndarray, ends: np.ndarray):
    """Compressed bytes have no finer place than their whole stream."""
    lo, hi = int(starts.min()), int(ends.max())
    return lambda a, b: (np.full(b - a, lo, np.int64), np.full(b - a, hi, np.int64))


def _base64(layer: Layer, most: int):
    for m in chain(_BASE64.finditer(layer.text), _WRAPPED.finditer(layer.text)):
        signs = _BREAK.sub("", m[0])
        if len(signs) < 16:
            continue
        at = None  # the places of the signs, once they are asked for
        run = signs.rstrip("=").replace("-", "+").replace("_", "/")
        for shift in range(4):  # what is glued to its front moves the run against its quads
            own = run[shift:]
            own = own[: len(own) - (len(own) % 4 == 1)]
            raw = base64.b64decode(own + "=" * (-len(own) % 4))

            def place(a, b):
                """Four signs make three bytes: a byte lies over its quad."""
                nonlocal at
                if at is None:
                    stay = np.ones(len(m[0]), bool)
                    for gap in _BREAK.finditer(m[0]):
                        stay[gap.start() : gap.end()] = False
                    at = m.start() + np.flatnonzero(stay)
                quad = np.arange(a, b) // 3 * 4 + shift
                return layer.starts[at[quad]], layer.ends[at[np.minimum(quad + 3, len(at) - 1)]]

            yield from _opened(raw, place, most)


def _packed(layer: Layer, most: int):
    """Compressed bytes in the layer, written as escapes or each as the character of its value."""
    def place(a, b):
        return layer.starts[a:b], layer.ends[a:b]

    # a character beyond a byte stands for itself in no stream, so any will do
    yield from _opened(layer.text.encode("latin-1", "replace"), place, most, text_too=False)
    for sign, form in _BYTE_FORMS:
        if sign not in layer.text:
            continue
        found = list(form.finditer(layer.text))
        raw, at = [], 0
        for m in found:
            code = m[m.lastindex]
            value = 32 if code == "+" else _PLAIN_ESCAPES[code] if m[0][1:] == code and sign == "\\" else int(code, 16)
            raw += [layer.text[at : m.start()].encode("latin-1", "replace"), bytes([value])]
            at = m.end()
        raw = b"".join([*raw, layer.text[at:].encode("latin-1", "replace")])

        first = None

        def place(a, b):
            nonlocal first
            if first is None:
                stay = np.ones(len(layer.text), bool)
                for m in found:
                    stay[m.start() + 1 : m.end()] = False
                first = np.append(np.flatnonzero(stay), len(stay))
            return layer.starts[first[a:b]], layer.ends[first[a + 1 : b + 1] - 1]

        yield from _opened(raw, place, most, text_too=False)


def _mark(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass")).digest()


def layers(text: str, most: int = 1 << 24):
    """Every layer below ``text``, each place and content once, nearest first."""
    if not ("%" in text or "\\" in text or _BASE64.search(text) or _WRAPPED.search(text) or _MAGIC.search(text.encode("latin-1", "replace"))):
        return
    place = np.arange(len(text), dtype=np.int64)
    work, met = deque([Layer(text, place, place + 1)]), {_mark(f"0:{len(text)}:{text}")}
    while work:
        layer = work.popleft()
        for new in (*_url(layer), *_unicode(layer), *_base64(layer, most), *_packed(layer, most)):
            if not new.text:
                continue
            where = f"{new.starts.min()}:{new.ends.max()}:"
            mark = _mark(where + new.text)
            if mark not in met:
                met.add(mark)
                work.append(new)
                yield new


def all_spans(text: str, most: int = 1 << 24) -> tuple[list[Span], list[Span]]:
    """The base spans of ``text``, and these with the spans found in all layers below it."""
    base = base_spans(text)
    more = [(k, *layer.source(a, b)) for layer in layers(text, most) for k, a, b in base_spans(layer.text)]
    return base, in_order(base + more) if more else base


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 1 << 24) -> DataFrame:
    """id, base_spans and spans, arrays of (kind, start, stop) in code points, for every row.

    A null or empty text has no spans. Ids may be null or repeat; each row is
    scanned by itself and no other column is read. A span found in a layer covers
    the characters of the text that it was decoded from; spans of equal kind and
    place are one. Compressed content of more than ``most`` bytes stays closed,
    which bounds a task's memory; everything else is opened at any depth.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def rows(spans):
        return [{"kind": k, "start": a, "stop": b} for k, a, b in spans]

    def work():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            found = [all_spans(t, most) for t in part.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([
                part.column("id"), pa.array([rows(x) for x, _ in found], pa.list_(span)), pa.array([rows(x) for _, x in found], pa.list_(span)),
            ], ["id", "base_spans", "spans"])

        return step

    kind = "array<struct<kind:string,start:long,stop:long>>"
    return per_slice(id_and_text(docs, id_col, text_col), work, f"id long, base_spans {kind}, spans {kind}")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]", most: int = 1 << 24) -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mark``; null texts stay null.

    Overlapping spans are replaced together. All other columns pass through.
    """
    at = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        out, end = [], 0
        for _, a, b in all_spans(text, most)[1]:
            if a >= end:
                out += [text[end:a], mark]
            end = max(end, b)
        return "".join([*out, text[end:]])

    def work():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            new = pa.array([clean(t) for t in part.column(at).to_pylist()], part.schema.field(at).type)
            return pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(part.columns)], schema=part.schema)

        return step

    return per_slice(docs, work, docs.schema)
