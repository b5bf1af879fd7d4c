"""Extraction backends behind an Arrow boundary: file bytes in, candidate texts out, failures as rows.

A backend is a function bytes -> text, registered for a source format under a method name and rank. A file whose format has no
backend, or whose backends all fail, gives rows with ok = false and the error; no file ends the job. Null contents count as failures.
"""

from __future__ import annotations

import io
import re
import shutil
import subprocess
import tempfile
import traceback
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "variant_id string, method string, method_rank int, source string, text string, ok boolean, error string"
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
BACKENDS: dict[str, list[tuple[str, int, str, Callable[[bytes], str]]]] = {}


def backend(source_format: str, method: str, rank: int, source: str = "native"):
    """Registers a backend; lower ranks win ties of length. `source` tells plain readers from the structured conversion."""

    def add(f: Callable[[bytes], str]) -> Callable[[bytes], str]:
        BACKENDS.setdefault(source_format, []).append((method, rank, source, f))
        return f

    return add


def _body(content: bytes) -> ElementTree.Element:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return ElementTree.fromstring(z.read("word/document.xml")).find(f"{W}body")


def _text(node: ElementTree.Element) -> str:
    return "".join(x.text or "" if x.tag == f"{W}t" else "\t" if x.tag == f"{W}tab" else "\n" for x in node.iter() if x.tag in (f"{W}t", f"{W}tab", f"{W}br"))


@backend("docx", "docx_in_order", 1)
def docx_in_order(content: bytes) -> str:
    """All paragraphs, those of tables too, in the order of the document."""
    return "\n\n".join(t for p in _body(content).iter(f"{W}p") if (t := _text(p)).strip())


@backend("docx", "docx_paragraphs_then_tables", 2)
def docx_paragraphs_then_tables(content: bytes) -> str:
    """Paragraphs first, then a line for each table row with its cells divided by bars."""
    body = _body(content)
    out = [t for p in body.findall(f"{W}p") if (t := _text(p)).strip()]
    for row in body.iter(f"{W}tr"):
        cells = [" ".join(_text(c).split()) for c in row.findall(f"{W}tc")]
        if any(cells):
            out.append(" | ".join(cells))
    return "\n".join(out)


@backend("docx", "docx_all_parts", 3)
def docx_all_parts(content: bytes) -> str:
    """Headers, the body in order, footnotes and footers."""
    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        for part in ("header", "document", "footnotes", "footer"):
            for name in sorted(n for n in names if re.fullmatch(rf"word/{part}\d*\.xml", n)):
                out += [t for p in ElementTree.fromstring(z.read(name)).iter(f"{W}p") if (t := _text(p)).strip()]
    return "\n".join(out)


@backend("docx", "docling_docx_simple_pipeline", 1, "docling")
def docx_structured(content: bytes) -> str:
    """Markdown: headings by style, list items, tables with bars, in the order of the document."""
    out = []
    for node in _body(content):
        if node.tag == f"{W}tbl":
            rows = [[" ".join(_text(c).split()) for c in r.findall(f"{W}tc")] for r in node.findall(f"{W}tr")]
            lines = [f"| {' | '.join(r)} |" for r in rows if any(r)]
            out.append("\n".join([*lines[:1], "|" + "---|" * len(rows[0]), *lines[1:]] if lines else []))
        elif node.tag == f"{W}p" and (t := _text(node).strip()):
            style = node.find(f"{W}pPr/{W}pStyle")
            level = re.fullmatch(r"(?:Heading|heading )?(\d)", style.get(f"{W}val", "")) if style is not None else None
            out.append(f"{'#' * int(level[1])} {t}" if level else f"- {t}" if node.find(f"{W}pPr/{W}numPr") is not None else t)
    return "\n\n".join(x for x in out if x)


def doc_to_docx(content: bytes, timeout: float = 360.0) -> bytes:
    """A .doc file as .docx by an office program of the executor, with a profile of its own; an error where there is none."""
    program = shutil.which("soffice") or shutil.which("libreoffice")
    if not program:
        raise RuntimeError("no converter for doc on this executor")
    with tempfile.TemporaryDirectory(prefix="doc-") as d:  # an executor's scratch, gone with the call
        with open(f"{d}/in.doc", "wb") as f:
            f.write(content)
        subprocess.run([program, "--headless", f"-env:UserInstallation=file://{d}/profile", "--convert-to", "docx", "--outdir", f"{d}/out", f"{d}/in.doc"], check=True, capture_output=True, timeout=timeout)
        with open(f"{d}/out/in.docx", "rb") as f:
            return f.read()


@backend("txt", "plain_text", 1)
def plain_text(content: bytes) -> str:
    return content.decode("utf-8-sig", "replace")


@backend("html", "html_text", 1)
def html_text(content: bytes) -> str:
    import html

    text = re.sub(r"(?is)<(script|style)\b.*?</\1>", " ", content.decode("utf-8", "replace"))
    return html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"(?i)</?(p|div|br|tr|h\d|li)\b[^>]*>", "\n", text)))


def candidates(files: DataFrame, timeout: float = 360.0) -> DataFrame:
    """SCHEMA rows, one for each backend of each file of (variant_id, source_format, content). A .doc file is converted once and read by
    the backends of .docx; where it cannot be converted it is one failure row."""
    backends = dict(BACKENDS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for v, fmt, content in zip(batch["variant_id"], batch["source_format"], batch["content"]):
                found = backends.get("docx" if fmt == "doc" else fmt, [])
                if fmt == "doc":
                    try:
                        content = doc_to_docx(bytes(content), timeout)
                    except Exception as e:  # noqa: BLE001
                        rows.append((v, None, None, "native", None, False, f"{type(e).__name__}: {e}"))
                        continue
                if not found:
                    rows.append((v, None, None, "native", None, False, f"no backend for {fmt}"))
                for method, rank, source, f in found:
                    try:
                        rows.append((v, method, rank, source, f(bytes(content)), True, None))
                    except Exception as e:  # noqa: BLE001 - a broken file is a row
                        rows.append((v, method, rank, source, None, False, f"{type(e).__name__}: {e}\n{traceback.format_exc()}"))
            yield pd.DataFrame(rows, columns=["variant_id", "method", "method_rank", "source", "text", "ok", "error"]).astype({"method_rank": "Int32"})

    return files.select("variant_id", "source_format", "content").mapInPandas(run, SCHEMA)


def split_by_status(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that were read, failures)."""
    ok = F.coalesce("ok", F.lit(False))
    return rows.filter(ok), rows.filter(~ok)


def markdown_of(title: F.Column, text: F.Column) -> F.Column:
    """A document in markdown where an engine gave none."""
    return F.concat(F.lit("# "), title, F.when(F.coalesce(text, F.lit("")) == "", F.lit("\n")).otherwise(F.concat(F.lit("\n\n"), text, F.lit("\n"))))
