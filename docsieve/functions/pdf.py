"""A small PDF reader: information dictionary, pages, words (inventory D1-D5, S7).

It reads plain and Flate-compressed content streams of unencrypted files with simple
text operators; other files give ``error``.  Page numbers and word counts follow the
page objects; words are what white space separates, counting an empty page as one.
"""

from __future__ import annotations

import re
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj(.*?)endobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.S)
_STRING = rb"\((?:\\.|[^\\()])*\)"
_SHOW = re.compile(rb"(" + _STRING + rb")\s*(?:Tj|'|\")|\[((?:\s*(?:" + _STRING + rb"|[-\d.]+))*)\s*\]\s*TJ|(T\*|Td|TD|Tm|ET)", re.S)


def _text(raw: bytes) -> str:
    out = re.sub(rb"\\([nrtbf()\\])", lambda m: {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b""}.get(m[1], m[1]), raw[1:-1])
    out = re.sub(rb"\\([0-7]{1,3})", lambda m: bytes([int(m[1], 8) & 255]), out)
    return out[2:].decode("utf-16-be", "replace") if out.startswith(b"\xfe\xff") else out.decode("latin-1")


def _stream(body: bytes) -> bytes:
    m = _STREAM.search(body)
    if not m:
        return b""
    return zlib.decompress(m[1]) if b"FlateDecode" in body[: m.start()] else m[1]


def read(data: bytes) -> dict:
    """metadata (map), pages, words, words_by_page."""
    if not data.startswith(b"%PDF-"):
        raise ValueError("not a PDF")
    objects = {int(n): body for n, body in _OBJECT.findall(data)}
    info = {"PDFFormatVersion": data[5:8].decode("latin-1")}
    if m := re.search(rb"/Info\s+(\d+)\s+\d+\s+R", data):
        for k, v in re.findall(rb"/(\w+)\s*(" + _STRING + rb")", objects.get(int(m[1]), b"")):
            info[k.decode()] = _text(v)
    pages = [b for _, b in sorted(objects.items()) if re.search(rb"/Type\s*/Page(?![s\w])", b)]
    if not pages:
        raise ValueError("no pages")
    words = 0
    for page in pages:
        refs = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", page)
        content = b"\n".join(_stream(objects.get(int(n), b"")) for n in re.findall(rb"(\d+)\s+\d+\s+R", refs[1])) if refs else b""
        text = []
        for show, array, move in _SHOW.findall(content):
            text.append(_text(show) if show else "".join(_text(s) for s in re.findall(_STRING, array)) if array else "\n")
        words += words_of("".join(text))
    return {"metadata": info, "pages": len(pages), "words": words, "words_by_page": words // len(pages), "error": None}


def words_of(page: str) -> int:
    """Parts between white space; blanks at the ends count as a part, an empty page as one."""
    return len(re.split(r"[\s﻿]+", page))


_INFO = T.StructType([T.StructField("metadata", T.MapType(T.StringType(), T.StringType())), T.StructField("pages", T.IntegerType()), T.StructField("words", T.IntegerType()), T.StructField("words_by_page", T.IntegerType()), T.StructField("error", T.StringType())])


@F.pandas_udf(_INFO)
def pdf_info(contents: pd.Series) -> pd.DataFrame:
    rows = []
    for data in contents:
        try:
            rows.append(read(bytes(data) if data is not None else b""))
        except (ValueError, zlib.error) as e:
            rows.append({"metadata": None, "pages": None, "words": None, "words_by_page": None, "error": str(e)})
    return pd.DataFrame(rows, columns=["metadata", "pages", "words", "words_by_page", "error"])


def page_words(page: Column) -> Column:
    """The word count of one page's text, as above."""
    return F.size(F.split(page, r"[\s\x{feff}]+"))
