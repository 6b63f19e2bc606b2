"""Text of PDF files (S23): pages in order, joined by newlines; what cannot be read gives the empty text.

A small reader of what articles are made of: objects (found by their marks, so a broken cross-reference table does no harm), object streams, Flate with its predictors, the page
tree, text operators, and the character maps of fonts. Encrypted files and images of text have none.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OBJECT = re.compile(rb"(?<![0-9])([0-9]+)[ \t\r\n]+([0-9]+)[ \t\r\n]+obj\b")
_TOKEN = re.compile(rb"\s+|%[^\r\n]*|(<<|>>|[\[\]{}])|(\()|<([0-9A-Fa-f\s]*)>|/([^\s()<>\[\]{}/%]*)|([^\s()<>\[\]{}/%]+)")
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
#: Nested dictionaries and page trees are read this deep.
_DEPTH = 64


class Name(str):
    """A name such as /Page."""


class Ref(int):
    """A reference to an object by its number."""


class Op(bytes):
    """A word that is none of a number, true, false and null: an operator."""


def _string(raw: bytes, at: int) -> tuple[bytes, int]:
    """The literal string whose bracket opens before ``at``, and where it ends."""
    out, depth, start = [], 1, at
    while at < len(raw):
        c = raw[at : at + 1]
        if c == b"\\":
            out.append(raw[start:at])
            digits = re.match(rb"[0-7]{1,3}", raw[at + 1 : at + 4])
            if digits:
                out.append(bytes([int(digits[0], 8) & 255]))
                at += 1 + len(digits[0])
            else:
                follow = raw[at + 1 : at + 2]
                at += 3 if raw[at + 1 : at + 3] == b"\r\n" else 2
                out.append(b"" if follow in b"\r\n" else _ESCAPES.get(follow, follow))
            start = at
            continue
        depth += (c == b"(") - (c == b")")
        if not depth:
            break
        at += 1
    return b"".join([*out, raw[start:at]]), at + 1


def tokens(raw: bytes, at: int = 0) -> Iterator[tuple[object, int]]:
    """(token, where it ends): brackets as text, strings as bytes, names, numbers, operators."""
    while at < len(raw):
        m = _TOKEN.match(raw, at)
        at = m.end() if m else at + 1  # a stray bracket is passed over
        if not m:
            continue
        if m[1]:
            yield m[1].decode(), at
        elif m[2]:
            value, at = _string(raw, at)
            yield value, at
        elif m[3] is not None:
            digits = re.sub(rb"\s", b"", m[3])
            yield bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()), at
        elif m[4] is not None:
            yield Name(re.sub(r"#([0-9A-Fa-f]{2})", lambda x: chr(int(x[1], 16)), m[4].decode("latin-1"))), at
        elif m[5]:
            word = m[5]
            if re.fullmatch(rb"[+-]?(\d+\.?\d*|\.\d+)", word):
                yield (float(word) if b"." in word else int(word)), at
            else:
                yield {b"true": True, b"false": False, b"null": None}.get(word, Op(word)), at


def value(raw: bytes, at: int = 0) -> tuple[object, int]:
    """The first object of ``raw`` from ``at``: dictionaries as dict, arrays as list; and where it ends."""
    stack: list[list] = [[]]
    opened: list[str] = []
    for token, end in tokens(raw, at):
        if token in ("<<", "[") and len(stack) < _DEPTH:
            stack.append([])
            opened.append(token)
        elif token in (">>", "]") and opened:
            items = stack.pop()
            made = items if opened.pop() == "[" else {k: v for k, v in zip(items[::2], items[1::2], strict=False) if isinstance(k, Name)}
            stack[-1].append(made)
        elif isinstance(token, Op) and token == b"R" and len(stack[-1]) > 1 and isinstance(stack[-1][-2], int):
            number = stack[-1][-2]
            stack[-1][-2:] = [Ref(number)]
        elif isinstance(token, Op) and token in (b"stream", b"endobj", b"obj"):
            return (stack[0][0] if stack[0] else None), end
        else:
            stack[-1].append(token)
        if len(stack) == 1 and isinstance(stack[0][-1], (dict, list)):
            return stack[0][0], end
    return (stack[0][0] if stack[0] else None), len(raw)


def _unpredicted(data: bytes, predictor: int, columns: int) -> bytes:
    """Undo the row filters that PNG has too."""
    if predictor < 10:
        return data
    out, above = [], bytearray(columns)
    for lo in range(0, len(data), columns + 1):
        kind, row = data[lo], bytearray(data[lo + 1 : lo + 1 + columns])
        for i in range(len(row)):
            left, up, corner = (row[i - 1] if i else 0), above[i], (above[i - 1] if i else 0)
            guess = left + up - corner
            nearest = min((abs(guess - left), 0, left), (abs(guess - up), 1, up), (abs(guess - corner), 2, corner))[2]
            row[i] = (row[i] + (0, left, up, (left + up) // 2, nearest)[kind if kind < 5 else 0]) & 255
        out.append(bytes(row))
        above = row + bytearray(columns - len(row))
    return b"".join(out)


class Document:
    def __init__(self, raw: bytes):
        self.raw = raw
        self.at = {int(m[1]): m.end() for m in _OBJECT.finditer(raw)}  # the last of a number counts
        self.packed: dict[int, object] = {}
        for number in list(self.at):
            found = self.get(Ref(number))
            if isinstance(found, dict) and found.get("Type") == "ObjStm":
                body, n = self.stream(number), int(self.get(found.get("N")) or 0)
                heads = [t for t, _ in zip(tokens(body), range(2 * n), strict=False)]
                first = int(self.get(found.get("First")) or 0)
                for (name, _), (offset, _) in zip(heads[::2], heads[1::2], strict=False):
                    if isinstance(name, int) and name not in self.at:
                        self.packed[name] = value(body, first + offset)[0]

    def get(self, found: object) -> object:
        """An object, whatever references lead to it."""
        for _ in range(_DEPTH):
            if not isinstance(found, Ref):
                return found
            found = value(self.raw, self.at[found])[0] if found in self.at else self.packed.get(found)
        return None

    def stream(self, number: int) -> bytes:
        """The decoded bytes of a stream; empty if its filter is not known."""
        if number not in self.at:
            return b""
        head, at = value(self.raw, self.at[number])
        m = re.compile(rb"\s*stream\r?\n").match(self.raw, at) if isinstance(head, dict) else None
        if not m:
            return b""
        size = self.get(head.get("Length"))
        end = m.end() + size if isinstance(size, int) and self.raw[m.end() + size :].lstrip()[:9] == b"endstream" else self.raw.find(b"endstream", m.end())
        data = self.raw[m.end() : end if end >= 0 else len(self.raw)]
        filters, options = self.get(head.get("Filter")), self.get(head.get("DecodeParms"))
        filters = filters if isinstance(filters, list) else [filters] if filters else []
        options = self.get(options[0]) if isinstance(options, list) and options else options
        if any(f != "FlateDecode" for f in filters):
            return b""
        for _ in filters:
            data = zlib.decompressobj().decompress(data)
        if isinstance(options, dict):
            data = _unpredicted(data, int(self.get(options.get("Predictor")) or 1), int(self.get(options.get("Columns")) or 1))
        return data

    def pages(self) -> list[dict]:
        """The pages in their order, each with the resources that it has or inherits."""
        numbers = [*self.at, *self.packed]
        roots = [d for n in numbers if isinstance(d := self.get(Ref(n)), dict) and d.get("Type") == "Catalog"]
        out: list[dict] = []
        seen: set[int] = set()

        def visit(node: object, resources: object, depth: int) -> None:
            if isinstance(node, Ref):
                if node in seen:
                    return
                seen.add(node)
            found = self.get(node)
            if not isinstance(found, dict) or depth > _DEPTH:
                return
            resources = found.get("Resources", resources)
            kids = self.get(found.get("Kids"))
            if isinstance(kids, list):
                for kid in kids:
                    visit(kid, resources, depth + 1)
            else:
                out.append(found | {"Resources": resources})

        if roots:
            visit(roots[-1].get("Pages"), None, 0)
        return out


def character_map(raw: bytes) -> tuple[int, dict[int, str]]:
    """(bytes of a code, text of each code) of a font's ToUnicode map."""
    out: dict[int, str] = {}
    width, words = 1, [t for t, _ in tokens(raw)]
    text = lambda b: b.decode("utf-16-be", "replace")
    for i, word in enumerate(words):
        if word == b"endcodespacerange" and i and isinstance(words[i - 1], bytes):
            width = max(1, len(words[i - 1]))
        elif word in (b"beginbfchar", b"beginbfrange"):
            end = next((j for j in range(i, len(words)) if words[j] in (b"endbfchar", b"endbfrange")), len(words))
            items, at = words[i + 1 : end], 0
            if word == b"beginbfchar":
                out.update((int.from_bytes(a), text(b)) for a, b in zip(items[::2], items[1::2], strict=False) if isinstance(a, bytes) and isinstance(b, bytes))
                continue
            while at + 2 < len(items):
                low, high = int.from_bytes(items[at]), min(int.from_bytes(items[at + 1]), int.from_bytes(items[at]) + 0xFFFF)
                if items[at + 2] == "[":
                    stop = items.index("]", at)
                    out.update((low + n, text(b)) for n, b in enumerate(items[at + 3 : stop]))
                    at = stop + 1
                else:
                    start, head = int.from_bytes(items[at + 2][-2:]), items[at + 2][:-2]
                    out.update((low + n, text(head + ((start + n) & 0xFFFF).to_bytes(2))) for n in range(high - low + 1))
                    at += 3
    return width, out


def _shown(raw: bytes, font: tuple[int, dict[int, str]] | None) -> str:
    if not font or not font[1]:
        return raw.decode("cp1252", "replace")
    width, chars = font
    return "".join(chars.get(int.from_bytes(raw[i : i + width]), "") for i in range(0, len(raw), width))


def page_text(doc: Document, page: dict) -> str:
    """The text that a page shows: a new line where the writing moves down, a space where it jumps to the right by a letter or more."""
    resources = doc.get(page.get("Resources"))
    listed = doc.get(resources.get("Font")) if isinstance(resources, dict) else None
    fonts = {}
    for name, ref in (listed or {}).items():
        font = doc.get(ref)
        mapped = font.get("ToUnicode") if isinstance(font, dict) else None
        fonts[name] = character_map(doc.stream(mapped)) if isinstance(mapped, Ref) else None
    contents = page.get("Contents")
    contents = doc.get(contents) if isinstance(doc.get(contents), list) else [contents]
    raw = b"\n".join(doc.stream(c) for c in contents if isinstance(c, Ref))
    out: list[str] = []
    font, args, nested = None, [], None

    def line() -> None:
        if out and out[-1] != "\n":
            out.append("\n")

    for token, _ in tokens(raw):
        if not isinstance(token, Op):
            if token == "[":
                nested = []
            elif token == "]":
                args, nested = [*args, nested or []], None
            else:
                (args if nested is None else nested).append(token)
            continue
        if token == b"Tf" and len(args) > 1:
            font = fonts.get(args[-2])
        elif token in (b"Td", b"TD") and len(args) > 1:
            line() if args[-1] else out.append(" ")
        elif token in (b"T*", b"Tm", b"ET"):
            line()
        elif token in (b"Tj", b"'", b'"') and args and isinstance(args[-1], bytes):
            line() if token != b"Tj" else None
            out.append(_shown(args[-1], font))
        elif token == b"TJ" and args and isinstance(args[-1], list):
            out += [_shown(x, font) if isinstance(x, bytes) else " " if isinstance(x, (int, float)) and x < -200 else "" for x in args[-1]]
        args = []
    return "\n".join(re.sub(" +", " ", x).strip() for x in "".join(out).split("\n")).strip("\n")


def text_of(raw: bytes | None) -> str:
    try:
        doc = Document(raw or b"")
        return "\n".join(page_text(doc, p) for p in doc.pages())
    except (ValueError, KeyError, IndexError, TypeError, AttributeError, zlib.error, RecursionError, MemoryError, OverflowError):
        return ""  # as an unreadable file has no text


def with_text(files: DataFrame, body_col: str = "body") -> DataFrame:
    """``files`` with ``text`` in place of the bytes in ``body_col``; null bytes and what cannot be read give the empty text."""
    rows = files.select(F.col(body_col).alias("_body"), *(c for c in files.columns if c not in (body_col, "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one file at a time
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*row.columns[1:], pa.array([text_of(row.column(0)[0].as_py())], pa.string())], [*row.schema.names[1:], "text"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[1:], T.StructField("text", T.StringType())]))


def read_pdfs(spark, path: str) -> DataFrame:
    """``path, text`` of the PDF files of a folder."""
    return with_text(spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", F.col("content").alias("body")))
