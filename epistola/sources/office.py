"""Texts of office files, from their bytes: DOCX and XLSX by the standard library, others by plug-ins."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.mail import extraction_method

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def docx_text(raw: bytes) -> str:
    root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(raw)).read("word/document.xml"))
    return "\n".join("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in root.iter(f"{_W}p"))


def xlsx_text(raw: bytes) -> str:
    """Sheets in order, a line for each row, cells joined by ` | `; empty cells and zeros are blank."""
    z = zipfile.ZipFile(io.BytesIO(raw))
    shared = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_S}si")]
    lines = []
    for name in sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0])):
        for row in ElementTree.fromstring(z.read(name)).iter(f"{_S}row"):
            cells = []
            for c in row.iter(f"{_S}c"):
                v = c.find(f"{_S}v")
                value = "".join(t.text or "" for t in c.iter(f"{_S}t")) if c.get("t") == "inlineStr" else "" if v is None else v.text or ""
                value = shared[int(value)] if c.get("t") == "s" and value else value
                cells.append("" if value in ("0", "0.0") else value)
            lines.append(" | ".join(cells))
    return "\n".join(lines)


READERS = {"docx": docx_text, "xlsx": xlsx_text}
_OUT = "path string, method string, text string, confidence double, success boolean, error string"


def extract(files: DataFrame, readers=None) -> DataFrame:
    """(path, method, text, confidence, success, error) of binaryFile rows; a method without a reader fails, and so does an empty text."""
    readers = READERS if readers is None else readers

    def run(frames):
        for frame in frames:
            out = []
            for path, raw, method in zip(frame["path"], frame["content"], frame["method"], strict=True):
                text, error = "", None
                try:
                    text = readers[method](bytes(raw))
                except KeyError:
                    error = f"no reader for {method}"
                except (zipfile.BadZipFile, ElementTree.ParseError, ValueError) as e:
                    error = type(e).__name__
                ok = error is None and bool(text.strip())
                out.append((path, method, text, 1.0 if ok else 0.0, ok, error))
            yield pd.DataFrame(out, columns=["path", "method", "text", "confidence", "success", "error"])

    return files.select("path", "content", extraction_method(F.col("path")).alias("method")).mapInPandas(run, _OUT)
