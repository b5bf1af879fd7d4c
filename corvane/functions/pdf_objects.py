"""A small reader of PDF pages: sizes and native text, for page scans without a rendering library.

It knows plain and compressed objects, object streams, page trees with inherited boxes, and text operators with simple or
mapped fonts. What it cannot read raises ValueError, which a page scan turns into a failure row.
"""

from __future__ import annotations

import re
import zlib

_OBJ = re.compile(rb"(\d+)\s+\d+\s+obj\b")
_REF = re.compile(rb"(\d+)\s+\d+\s+R\b")
_NUMBER = rb"[-+]?\d*\.?\d+"
_BOX = re.compile(rb"/MediaBox\s*\[\s*(%s)\s+(%s)\s+(%s)\s+(%s)\s*\]" % ((_NUMBER,) * 4))
_TOKEN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/\[\]()<>]+|%s|[A-Za-z'\"*]+" % _NUMBER, re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


class Document:
    def __init__(self, content: bytes):
        if b"%PDF" not in content[:1024]:
            raise ValueError("not a PDF")
        if b"/Encrypt" in content:
            raise ValueError("encrypted PDF")
        self.objects: dict[int, bytes] = {}
        for m in _OBJ.finditer(content):
            end = content.find(b"endobj", m.end())
            if b"stream" in content[m.end() : end]:
                end = content.find(b"endobj", content.find(b"endstream", m.end()))
            self.objects[int(m[1])] = content[m.end() : end if end >= 0 else len(content)]
        for body in [b for b in self.objects.values() if re.search(rb"/Type\s*/ObjStm", b)]:
            data, first, n = self.stream(body), self.number(body, b"First"), self.number(body, b"N")
            head = list(map(int, data[:first].split()))[: 2 * n]
            for k in range(0, len(head), 2):
                start, end = first + head[k + 1], first + head[k + 3] if k + 3 < len(head) else len(data)
                self.objects.setdefault(head[k], data[start:end])

    @staticmethod
    def number(body: bytes, name: bytes) -> int:
        m = re.search(rb"/%s\s+(\d+)" % name, body)
        if not m:
            raise ValueError(f"no {name.decode()} in a stream")
        return int(m[1])

    @staticmethod
    def stream(body: bytes) -> bytes:
        head, mark, data = body.partition(b"stream")
        if not mark:
            return b""
        data = data[2:] if data[:2] == b"\r\n" else data[1:] if data[:1] in b"\r\n" else data
        data = data[: data.rfind(b"endstream")]
        if b"/FlateDecode" in head:
            return zlib.decompressobj().decompress(data)
        if b"/Filter" in head:
            raise ValueError("a stream filter that is not known")
        return data

    def reference(self, body: bytes, name: bytes) -> list[bytes]:
        """Objects that an entry refers to, one or an array; a dictionary in its place is its own object."""
        m = re.search(rb"/%s\s*(\[[^\]]*\]|\d+\s+\d+\s+R|<<.*)" % name, body, re.S)
        if not m:
            return []
        return [m[1]] if m[1].startswith(b"<<") else [self.objects.get(int(r), b"") for r in _REF.findall(m[1])]

    def pages(self) -> list[tuple[float, float, str]]:
        """(width, height, text) of each page in order."""
        roots = [r for b in self.objects.values() if re.search(rb"/Type\s*/Catalog\b", b) for r in self.reference(b, b"Pages")]
        out: list[tuple[float, float, str]] = []
        for root in roots[-1:]:
            self._walk(root, None, b"", out, 0)
        if not out:
            raise ValueError("no pages")
        return out

    def _walk(self, node: bytes, box, resources: bytes, out: list, depth: int) -> None:
        if depth > 60:
            raise ValueError("a page tree without end")
        m = _BOX.search(node)
        box = tuple(map(float, m.groups())) if m else box
        own = self.reference(node, b"Resources")
        resources = own[0] if own else resources
        if re.search(rb"/Type\s*/Page\b", node):
            if box is None:
                raise ValueError("a page without a box")
            content = b"\n".join(self.stream(c) for c in self.reference(node, b"Contents"))
            out.append((abs(box[2] - box[0]), abs(box[3] - box[1]), self.text(content, self.fonts(resources))))
        else:
            for kid in self.reference(node, b"Kids"):
                self._walk(kid, box, resources, out, depth + 1)

    def fonts(self, resources: bytes) -> dict[bytes, dict[int, str]]:
        """Code maps of the fonts that have one, by name."""
        out = {}
        for table in self.reference(resources, b"Font"):
            for name, number in re.findall(rb"/([^\s/<>\[\]]+)\s+(\d+)\s+\d+\s+R", table):
                for cmap in self.reference(self.objects.get(int(number), b""), b"ToUnicode"):
                    out[name] = _code_map(self.stream(cmap))
        return out

    @staticmethod
    def text(content: bytes, fonts: dict[bytes, dict[int, str]]) -> str:
        out: list[str] = []
        stack: list[bytes] = []
        font: dict[int, str] | None = None
        for t in _TOKEN.findall(content):
            if t[:1] in b"(<[]/" or re.fullmatch(_NUMBER, t):
                stack.append(t)
                continue
            if t == b"Tf" and len(stack) > 1:
                font = fonts.get(stack[-2][1:])
            elif t in (b"Tj", b"TJ", b"'", b'"'):
                if t in (b"'", b'"'):
                    out.append("\n")
                for s in stack:
                    if s[:1] in b"(<" and s[:2] != b"<<":
                        out.append(_string(s, font))
                    elif t == b"TJ" and re.fullmatch(_NUMBER, s) and float(s) < -200:
                        out.append(" ")
            elif t in (b"Td", b"TD", b"T*", b"Tm", b"ET"):
                out.append("\n")
            stack = []
        return re.sub(r"\n{2,}", "\n", "".join(out)).strip("\n")


def _bytes(token: bytes) -> bytes:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1]).decode()
        return bytes.fromhex(digits + "0" * (len(digits) % 2))
    return re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)


def _string(token: bytes, font: dict[int, str] | None) -> str:
    raw = _bytes(token)
    if font is None:
        return raw.decode("cp1252", "replace")
    wide = any(k > 255 for k in font) or token[:1] == b"<"
    codes = [int.from_bytes(raw[k : k + 2], "big") for k in range(0, len(raw), 2)] if wide else list(raw)
    return "".join(font.get(c, "�") for c in codes)


def _code_map(cmap: bytes) -> dict[int, str]:
    out: dict[int, str] = {}
    text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
    for block in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.S):
        out.update((int(a, 16), text(b)) for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block))
    for block in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.S):
        for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            first = int(c, 16)
            out.update((k, chr(first + k - int(a, 16))) for k in range(int(a, 16), int(b, 16) + 1))
    return out
