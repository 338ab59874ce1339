"""A plain PDF reader and writer without libraries: info dictionary, XMP packet, page texts and page images.

It reads unencrypted files whose streams are plain or flate-coded, object streams included; texts in single-byte encodings; 8-bit
grey and RGB images. Fonts with encodings of their own, other image filters and vector graphics need a provider of another
kind. Metadata is written as an incremental update, which leaves every byte of the file before it as it is."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

_SPACE, _END = b"\x00\t\n\x0c\r ", b"\x00\t\n\x0c\r ()<>[]{}/%"
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


class Name(str):
    pass


class Ref(int):
    pass


class Word(bytes):
    """An operator or keyword."""


@dataclass
class Stream:
    fields: dict
    raw: bytes

    def data(self) -> bytes:
        kinds = self.fields.get("Filter", [])
        for kind in [kinds] if isinstance(kinds, Name) else kinds:
            if kind not in ("FlateDecode", "Fl"):
                raise ValueError(f"no filter for {kind}")
            out = zlib.decompressobj().decompress(self.raw)
            return _unpredict(out, self.fields.get("DecodeParms") or {})
        return self.raw


def _unpredict(data: bytes, parms: dict) -> bytes:
    """Undoes the row filters of PNG, which xref streams and images may have."""
    if int(parms.get("Predictor", 1)) < 10:
        return data
    step = max(1, int(parms.get("Colors", 1)) * int(parms.get("BitsPerComponent", 8)) // 8)
    width = step * int(parms.get("Columns", 1))
    rows, above = [], np.zeros(width, np.uint8)
    for at in range(0, len(data) - width, width + 1):
        kind, row = data[at], np.frombuffer(data, np.uint8, width, at + 1).copy()
        if kind == 1:
            for i in range(step, width):
                row[i] = (int(row[i]) + int(row[i - step])) & 255
        elif kind == 2:
            row += above
        elif kind == 3:
            for i in range(width):
                row[i] = (int(row[i]) + (int(row[i - step] if i >= step else 0) + int(above[i])) // 2) & 255
        elif kind == 4:
            for i in range(width):
                a, b, c = (int(row[i - step]), int(above[i]), int(above[i - step])) if i >= step else (0, int(above[i]), 0)
                near = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
                row[i] = (int(row[i]) + near) & 255
        rows.append(row)
        above = row
    return b"".join(r.tobytes() for r in rows)


class Reader:
    """Values of PDF syntax, one after the other."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def skip(self) -> None:
        d = self.data
        while self.at < len(d):
            if d[self.at] in _SPACE:
                self.at += 1
            elif d[self.at] == 0x25:
                while self.at < len(d) and d[self.at] not in b"\r\n":
                    self.at += 1
            else:
                return

    def string(self) -> bytes:
        d, out, depth = self.data, bytearray(), 1
        self.at += 1
        while self.at < len(d):
            c = d[self.at : self.at + 1]
            self.at += 1
            if c == b"\\":
                c = d[self.at : self.at + 1]
                if m := re.compile(rb"[0-7]{1,3}").match(d, self.at):
                    out.append(int(m[0], 8) & 255)
                    self.at = m.end()
                    continue
                self.at += 1
                if c not in (b"\r", b"\n"):
                    out += _ESCAPES.get(c, c)
                continue
            depth += (c == b"(") - (c == b")")
            if not depth:
                break
            out += c
        return bytes(out)

    def value(self):
        """The next value; None at the end of the data or of a list."""
        self.skip()
        d, at = self.data, self.at
        if at >= len(d):
            return None
        if d[at : at + 2] == b"<<":
            self.at += 2
            out = {}
            while (key := self.value()) is not None:
                out[str(key)] = self.value()
            return out
        c = d[at : at + 1]
        if c == b"(":
            return self.string()
        if c == b"<":
            end = d.find(b">", at)
            self.at = (end if end >= 0 else len(d)) + 1
            digits = re.sub(rb"[^0-9A-Fa-f]", b"", d[at + 1 : self.at - 1])
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        if c == b"[":
            self.at += 1
            out = []
            while (x := self.value()) is not None:
                out.append(x)
            return out
        if c in (b"]", b">", b")", b"}", b"{"):
            self.at += 2 if d[at : at + 2] == b">>" else 1
            return None if c in (b"]", b">") else self.value()
        self.at += 1
        while self.at < len(d) and d[self.at] not in _END:
            self.at += 1
        word = d[at : self.at]
        if c == b"/":
            return Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda m: bytes([int(m[1], 16)]), word[1:]).decode("latin-1"))
        if m := re.compile(rb"(\d+)\s+\d+\s+R\b").match(d, at):
            self.at = m.end()
            return Ref(int(m[1]))
        if re.fullmatch(rb"[+-]?(\d+\.?\d*|\.\d+)", word):
            return float(word) if b"." in word else int(word)
        return {b"true": True, b"false": False}.get(word, Word(word))


def text_of(raw: bytes) -> str:
    """A text string: UTF-16 or UTF-8 behind its mark, else single bytes."""
    if raw[:2] == b"\xfe\xff":
        return raw[2:].decode("utf-16-be", "replace")
    return raw[3:].decode("utf-8", "replace") if raw[:3] == b"\xef\xbb\xbf" else raw.decode("latin-1")


class Pdf:
    def __init__(self, content: bytes):
        if content[:5] != b"%PDF-":
            raise ValueError("not a PDF")
        self.content, self.objects, self.trailer = content, {}, {}
        for m in re.finditer(rb"(?<![0-9])(\d+)\s+\d+\s+obj\b", content):
            reader = Reader(content, m.end())
            x = reader.value()
            if isinstance(x, dict) and (s := re.compile(rb"\s*stream(\r\n|\n|\r)").match(content, reader.at)):
                n = x.get("Length")
                end = s.end() + n if isinstance(n, int) and not isinstance(n, Ref) else -1
                if end < 0 or not re.compile(rb"\s*endstream").match(content, end):
                    end = content.find(b"endstream", s.end())
                x = Stream(x, content[s.end() : end if end >= 0 else len(content)])
            self.objects[int(m[1])] = x
        for s in [x for x in self.objects.values() if isinstance(x, Stream)]:
            kind = s.fields.get("Type")
            if kind == "ObjStm":
                data = s.data()
                head = Reader(data)
                pairs = [(head.value(), head.value()) for _ in range(s.fields["N"])]
                for number, at in pairs:
                    self.objects.setdefault(number, Reader(data, s.fields["First"] + at).value())
            elif kind == "XRef":
                self.trailer |= {k: v for k, v in s.fields.items() if k in ("Root", "Info", "Size")}
        for m in re.finditer(rb"\btrailer\b", content):
            self.trailer |= Reader(content, m.end()).value() or {}

    def get(self, x):
        for _ in range(32):
            if not isinstance(x, Ref):
                return x
            x = self.objects.get(int(x))
        return None

    def info(self) -> dict[str, str]:
        """The info dictionary's texts."""
        return {k: text_of(v) for k, x in (self.get(self.trailer.get("Info")) or {}).items() if isinstance(v := self.get(x), bytes) and not isinstance(v, Word)}

    def xmp(self) -> str | None:
        s = self.get((self.get(self.trailer.get("Root")) or {}).get("Metadata"))
        return s.data().decode("utf-8", "replace") if isinstance(s, Stream) else None

    def pages(self) -> list[dict]:
        """The pages in order, with the resources that they inherit."""
        out, seen = [], set()
        todo = [((self.get(self.trailer.get("Root")) or {}).get("Pages"), {})]
        while todo:
            ref, above = todo.pop()
            node = self.get(ref)
            if not isinstance(node, dict) or isinstance(ref, Ref) and int(ref) in seen:
                continue
            seen |= {int(ref)} if isinstance(ref, Ref) else set()
            node = {**({"Resources": above["Resources"]} if "Resources" in above else {}), **node}
            if "Kids" in node:
                todo += [(k, node) for k in reversed(self.get(node["Kids"]) or [])]
            else:
                out.append(node)
        return out

    def page_text(self, page: dict) -> str | None:
        """The strings that the page shows, a line for each move to another; null if there are none."""
        found = self.get(page.get("Contents"))
        parts = [self.get(x) for x in (found if isinstance(found, list) else [found])]
        reader, stack, out = Reader(b"\n".join(p.data() for p in parts if isinstance(p, Stream))), [], []
        while reader.at < len(reader.data):
            x = reader.value()
            if not isinstance(x, Word):
                stack.append(x)
                continue
            if x in (b"Td", b"TD", b"T*", b"Tm", b"ET", b"'", b'"') and out and out[-1] != "\n":
                out.append("\n")
            if x in (b"Tj", b"'", b'"', b"TJ") and stack and stack[-1] is not None:
                for s in stack[-1] if isinstance(stack[-1], list) else [stack[-1]]:
                    if isinstance(s, bytes):
                        out.append(text_of(s))
                    elif isinstance(s, (int, float)) and s < -200:
                        out.append(" ")
            stack = []
        text = "".join(out).strip()
        return text or None

    def page_image(self, page: dict) -> tuple[int, int, int, bytes] | None:
        """Width, height, channels and pixels of the largest image on the page that can be read."""
        best = None
        for ref in (self.get((self.get(page.get("Resources")) or {}).get("XObject")) or {}).values():
            s = self.get(ref)
            if not isinstance(s, Stream) or s.fields.get("Subtype") != "Image" or self.get(s.fields.get("BitsPerComponent")) != 8:
                continue
            channels = {"DeviceGray": 1, "DeviceRGB": 3}.get(str(self.get(s.fields.get("ColorSpace"))))
            w, h = self.get(s.fields.get("Width")), self.get(s.fields.get("Height"))
            try:
                pixels = s.data() if channels else b""
            except ValueError:
                continue
            if channels and len(pixels) >= w * h * channels and (best is None or w * h > best[0] * best[1]):
                best = (w, h, channels, pixels[: w * h * channels])
        return best


def _write(x) -> bytes:
    if isinstance(x, Ref):
        return b"%d 0 R" % int(x)
    if isinstance(x, Name):
        return b"/" + b"".join(bytes([c]) if c not in _END and c > 32 and c != 35 else b"#%02X" % c for c in x.encode("latin-1"))
    if isinstance(x, dict):
        return b"<<" + b" ".join(_write(Name(k)) + b" " + _write(v) for k, v in x.items()) + b">>"
    if isinstance(x, list):
        return b"[" + b" ".join(map(_write, x)) + b"]"
    if isinstance(x, Word):
        return bytes(x)
    if isinstance(x, bytes):
        return b"<" + x.hex().encode() + b">"
    return {True: b"true", False: b"false"}[x] if isinstance(x, bool) else str(x).encode()


def with_metadata(content: bytes, info: dict[str, str | None], xmp: str | None) -> bytes:
    """The file with these info entries (null ones go, others stay) and this packet, as an incremental update."""
    pdf = Pdf(content)
    root = pdf.trailer.get("Root")
    if not isinstance(root, Ref) or not isinstance(pdf.get(root), dict):
        raise ValueError("no document catalogue")
    if "Encrypt" in pdf.trailer:
        raise ValueError("the file is encrypted")
    size = max([*pdf.objects, 0]) + 1
    old = pdf.get(pdf.trailer.get("Info")) or {}
    entries = {k: v for k, v in old.items() if k not in info} | {k: b"\xfe\xff" + v.encode("utf-16-be", "replace") for k, v in info.items() if v is not None}
    new = {size: _write(entries)}
    if xmp is not None:
        raw = xmp.encode()
        new[size + 1] = _write({"Type": Name("Metadata"), "Subtype": Name("XML"), "Length": len(raw)}) + b"\nstream\n" + raw + b"\nendstream"
        new[int(root)] = _write({**pdf.get(root), "Metadata": Ref(size + 1)})
    out, at = bytearray(content if content.endswith(b"\n") else content + b"\n"), {}
    for number, body in sorted(new.items()):
        at[number] = len(out)
        out += b"%d 0 obj\n" % number + body + b"\nendobj\n"
    start = len(out)
    out += b"xref\n" + b"".join(b"%d 1\n%010d 00000 n \n" % (n, p) for n, p in sorted(at.items()))
    before = re.findall(rb"startxref\s+(\d+)", content)
    tail = {"Size": size + 2, "Root": root, "Info": Ref(size)} | ({"Prev": int(before[-1])} if before else {})
    return bytes(out + b"trailer\n" + _write(tail) + b"\nstartxref\n%d\n%%%%EOF\n" % start)


DOCUMENT = "path string, info map<string,string>, xmp string, page_count int, error string"


def documents(files: DataFrame) -> DataFrame:
    """path, info, xmp, page_count, error of (path, content) rows; what isn't readable has an error and nulls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    p = Pdf(bytes(content))
                    rows.append((path, p.info(), p.xmp(), len(p.pages()), None))
                except Exception as e:  # a fault of the file is its own
                    rows.append((path, None, None, None, f"{type(e).__name__}: {e}"))
            out = pd.DataFrame(rows, columns=["path", "info", "xmp", "page_count", "error"])
            yield out.astype({"page_count": "Int32"})

    return files.select("path", "content").mapInPandas(run, DOCUMENT)


PAGE = "path string, page_number int, text string, image struct<width:int,height:int,channels:int,pixels:binary>"


def pages(files: DataFrame) -> DataFrame:
    """A row for each page of (path, content) rows: path, page_number (from 1), text, image; unreadable files have none. One
    file is open at a time and its pages leave in small frames."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    p = Pdf(bytes(content))
                    found = p.pages()
                except Exception:
                    continue
                for n, page in enumerate(found):
                    text = image = None
                    try:
                        text, image = p.page_text(page), p.page_image(page)
                    except Exception:  # this page shows what could be read
                        pass
                    image = dict(zip(("width", "height", "channels", "pixels"), image, strict=True)) if image else None
                    yield pd.DataFrame({"path": [path], "page_number": [n + 1], "text": [text], "image": [image]}).astype({"page_number": "int32", "text": object, "image": object})

    return files.select("path", "content").mapInPandas(run, PAGE)


def embed(files: DataFrame) -> DataFrame:
    """path, content, error of (path, content, info, packet) rows: the files with their metadata written into them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content, info, packet in zip(pdf["path"], pdf["content"], pdf["info"], pdf["packet"], strict=True):
                try:
                    row = (path, with_metadata(bytes(content), dict(info or {}), packet), None)
                except Exception as e:
                    row = (path, None, f"{type(e).__name__}: {e}")
                yield pd.DataFrame([row], columns=["path", "content", "error"])

    return files.select("path", "content", "info", "packet").mapInPandas(run, "path string, content binary, error string")
