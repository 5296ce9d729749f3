"""File types, encodings and texts from content (inventory T1-T7, S4).

A rule says at which offset which bytes stand, and what that tells; the table is compiled to
one expression over the first bytes of a file.  Containers whose structure can break have a
test of it behind their match: a file that fails it is ``application/octet-stream``, with the
reason as its error.  What no rule knows is text, if it can be decoded, or else binary.

Encodings follow from byte-order marks, from UTF-8 where it is valid, from where zero bytes
stand (UTF-16), and else from byte statistics; texts are decoded by what was found.  Only
files that are not valid UTF-8 leave the JVM for that.
"""

from __future__ import annotations

import codecs

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import tag_count

HEAD = 512
# Offset, bytes there (hexadecimal, a dot for any digit), type, description.  The first that fits counts.
RULES = (
    (0, "255044462D", "application/pdf", "PDF document"),
    (0, "504B0304.{52}6D696D65747970656170706C69636174696F6E2F657075622B7A6970", "application/epub+zip", "EPUB document"),
    (0, "504B0304.{52}6D696D65747970656170706C69636174696F6E2F766E642E6F617369732E6F70656E646F63756D656E742E74657874", "application/vnd.oasis.opendocument.text", "OpenDocument Text"),
    (0, "504B0304.{52}6D696D65747970656170706C69636174696F6E2F766E642E6F617369732E6F70656E646F63756D656E742E7370726561647368656574", "application/vnd.oasis.opendocument.spreadsheet", "OpenDocument Spreadsheet"),
    (0, "504B0304.*4D4554412D494E462F", "application/java-archive", "Java archive data (JAR)"),
    (0, "504B0304.*776F72642F", "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "Microsoft Word 2007+"),
    (0, "504B0304.*786C2F", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "Microsoft Excel 2007+"),
    (0, "504B0304.*7070742F", "application/vnd.openxmlformats-officedocument.presentationml.presentation", "Microsoft PowerPoint 2007+"),
    (0, "504B0304", "application/zip", "Zip archive data"),
    (0, "504B0506", "application/zip", "Zip archive data (empty)"),
    (0, "474946383761", "image/gif", "GIF image data, version 87a"),
    (0, "474946383961", "image/gif", "GIF image data, version 89a"),
    (0, "89504E470D0A1A0A", "image/png", "PNG image data"),
    (0, "FFD8FF", "image/jpeg", "JPEG image data"),
    (0, "49492A00", "image/tiff", "TIFF image data, little-endian"),
    (0, "4D4D002A", "image/tiff", "TIFF image data, big-endian"),
    (0, "52494646.{8}57454250", "image/webp", "RIFF (little-endian) data, Web/P image"),
    (0, "52494646.{8}57415645", "audio/x-wav", "RIFF (little-endian) data, WAVE audio"),
    (0, "52494646.{8}41564920", "video/x-msvideo", "RIFF (little-endian) data, AVI"),
    (0, "424D.{8}00000000", "image/bmp", "PC bitmap"),
    (0, "00000100", "image/x-icon", "MS Windows icon resource"),
    (0, "41542654464F524D", "image/vnd.djvu", "DjVu image or document"),
    (0, "494433", "audio/mpeg", "Audio file with ID3"),
    (0, "664C6143", "audio/flac", "FLAC audio bitstream data"),
    (0, "4F676753", "application/ogg", "Ogg data"),
    (4, "66747970", "video/mp4", "ISO Media"),
    (0, "1A45DFA3", "video/x-matroska", "Matroska data"),
    (0, "1F8B08", "application/gzip", "gzip compressed data"),
    (0, "425A68", "application/x-bzip2", "bzip2 compressed data"),
    (0, "FD377A585A00", "application/x-xz", "XZ compressed data"),
    (0, "28B52FFD", "application/zstd", "Zstandard compressed data"),
    (0, "377ABCAF271C", "application/x-7z-compressed", "7-zip archive data"),
    (0, "526172211A07", "application/x-rar", "RAR archive data"),
    (257, "7573746172", "application/x-tar", "POSIX tar archive"),
    (0, "D0CF11E0A1B11AE1", "application/msword", "Composite Document File V2 Document"),
    (0, "7B5C727466", "text/rtf", "Rich Text Format data"),
    (0, "25215053", "application/postscript", "PostScript document text"),
    (0, "7F454C46", "application/x-executable", "ELF"),
    (0, "4D5A", "application/x-dosexec", "MS-DOS executable"),
    (0, "CAFEBABE", "application/x-java-applet", "compiled Java class data"),
    (0, "0061736D", "application/wasm", "WebAssembly binary module"),
    (0, "53514C69746520666F726D6174203300", "application/x-sqlite3", "SQLite 3.x database"),
    (0, "50415231", "application/vnd.apache.parquet", "Apache Parquet"),
    (0, "4F54544F00", "font/otf", "OpenType font data"),
    (0, "774F4632", "font/woff2", "Web Open Font Format (Version 2)"),
)
BINARY = "application/octet-stream"
MIN_TAGS = 10
_HTML = r"(?is)^\s*(<!doctype\s+html|<html)"
#: The bytes that texts have none of, as libraries of magic numbers see them.
_CONTROL = r"[\x00-\x06\x0e-\x1a\x1c-\x1f\x7f]"


def _let(x: Column, f) -> Column:
    """``f(x)`` with ``x`` evaluated once, however often ``f`` names it."""
    return F.transform(F.array(x), f)[0]


# ---------------------------------------------------------------- texts
def is_xml(text: Column) -> Column:
    """Starts (after a byte-order mark and white space) with an XML declaration."""
    return F.coalesce(text.rlike(r"^\x{feff}?\s*<\?xml\s"), F.lit(False))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def mime_of_text(text: Column) -> Column:
    """XML by declaration or by more than ten tags, HTML by its opening, else plain text; null is binary."""
    return F.when(text.isNull(), BINARY).when(is_xml(first_line(text)), "application/xml").when(text.rlike(_HTML), "text/html").when(is_xml(text) | (tag_count(text) > MIN_TAGS), "application/xml").otherwise("text/plain")


def encoding(text: Column) -> Column:
    """us-ascii where no character is beyond it, else utf-8; null is binary."""
    return F.when(text.isNull(), "binary").when(F.octet_length(text) == F.length(text), "us-ascii").otherwise("utf-8")


def description(mime: Column) -> Column:
    return F.when(mime == "application/xml", "XML 1.0 document, text").when(mime == "text/html", "HTML document, text").when(mime == "text/plain", "text").when(mime == "application/pdf", "PDF document").otherwise("data")


# ---------------------------------------------------------------- encodings
def sniff(raw: bytes) -> tuple[str, str | None]:
    """(encoding, text) of bytes that are not plain UTF-8; the text of binary ones is None.

    UTF-16 without a mark shows by its zero bytes, most of them on one side.  One-byte texts in
    which most letters lie beyond ASCII are Cyrillic: of its code pages the one in which most
    of these are small letters, as capitals are rare.  Others are Western."""
    for mark, name in ((codecs.BOM_UTF32_LE, "utf-32le"), (codecs.BOM_UTF32_BE, "utf-32be"), (codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16le"), (codecs.BOM_UTF16_BE, "utf-16be")):
        if raw.startswith(mark) and (text := _as(raw[len(mark) :], name)) is not None:
            return name, text
    if raw.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)):  # a mark, and then none of what it promises
        return "binary", None
    data = np.frombuffer(raw, np.uint8)
    zero = data == 0
    if zero.any():
        for name, side in (("utf-16le", 1), ("utf-16be", 0)):
            if len(data) % 2 == 0 and zero[side::2].mean() > 0.5 and zero[1 - side :: 2].mean() < 0.05 and (text := _as(raw, name)) is not None:
                return name, text
        return "binary", None
    counts = np.bincount(data, minlength=256)
    if counts[:7].sum() + counts[14:27].sum() + counts[28:32].sum() + counts[127]:
        return "binary", None
    high = int(counts[128:].sum())
    letters = int(counts[65:91].sum() + counts[97:123].sum())
    if high and high > 0.6 * (high + letters):
        best = None
        for name in ("windows-1251", "koi8-r", "iso-8859-5"):
            text = _as(raw, name)
            if text is not None:
                beyond = [c for c in text if ord(c) > 127]
                fit = sum(c.islower() - 2 * (not c.isalpha()) for c in beyond)
                if best is None or fit > best[0]:
                    best = (fit, name, text)
        if best and best[0] > 0.4 * high:
            return best[1], best[2]
    if not counts[128:160].sum():
        return "iso-8859-1", raw.decode("latin-1")
    text = _as(raw, "windows-1252")
    return ("windows-1252", text) if text is not None else ("unknown-8bit", raw.decode("latin-1"))


def _as(raw: bytes, name: str) -> str | None:
    """Decoded, or None where it cannot be or holds what no text does."""
    try:
        text = raw.decode(name)
    except UnicodeDecodeError:
        return None
    return None if any(c < " " and c not in "\x07\b\t\n\x0b\x0c\r\x1b" for c in set(text)) else text


@F.pandas_udf(T.StructType([T.StructField("encoding", T.StringType()), T.StructField("text", T.StringType())]))
def _sniffed(contents: pd.Series) -> pd.DataFrame:
    rows = [(None, None) if c is None else sniff(bytes(c)) for c in contents]
    return pd.DataFrame(rows, columns=["encoding", "text"])


def decoding(content: Column) -> Column:
    """struct(encoding, text); binary has no text, null neither."""
    plain = F.is_valid_utf8(content.cast("string")) & ~content.cast("string").rlike(_CONTROL) & ~F.startswith(content, F.lit(codecs.BOM_UTF8))
    text = content.cast("string")
    own = F.struct(encoding(text).alias("encoding"), text.alias("text"))
    return F.when(content.isNull(), None).when(plain, own).otherwise(_sniffed(F.when(~plain, content)))


def decoded(content: Column) -> Column:
    """The text of a file by its encoding; of binary content as far as it is UTF-8."""
    return F.coalesce(decoding(content)["text"], F.make_valid_utf8(content.cast("string")))


# ---------------------------------------------------------------- types
def _structure(content: Column, mime: Column) -> Column:
    """What is broken in a container; null where nothing is, or there is no test for the type."""
    latin = content.cast("string")
    sound_pdf = F.contains(content, F.lit(b" obj")) & (F.contains(content, F.lit(b"trailer")) | F.contains(content, F.lit(b"startxref")))
    zipped = F.startswith(content, F.lit(b"PK"))
    png = F.contains(content, F.lit(b"IEND"))
    return (
        F.when((mime == "application/pdf") & ~sound_pdf, "PDF without objects or trailer")
        .when(zipped & ~F.contains(content, F.lit(b"PK\x05\x06")), "archive without central directory")
        .when((mime == "image/png") & ~png, "PNG without end")
        .when((mime == "application/gzip") & (F.octet_length(latin) < 18), "gzip data cut off")
    )


def _kind(content: Column) -> Column:
    """struct(mime, description) by the rules; null where none fits."""

    def by_rules(head: Column) -> Column:
        out = F.lit(None).cast("struct<mime:string,description:string>")
        for offset, pattern, mime, text in reversed(RULES):
            test = head.rlike(f"^.{{{2 * offset}}}{pattern}") if offset or "." in pattern else F.startswith(head, F.lit(pattern))
            out = F.when(test, F.struct(F.lit(mime).alias("mime"), F.lit(text).alias("description"))).otherwise(out)
        return out

    return _let(F.hex(F.substring(content, 1, HEAD)), by_rules)


# How encodings are named in descriptions.
_NAMED = {"us-ascii": "ASCII text", "utf-8": "UTF-8 Unicode text", "utf-16le": "Little-endian UTF-16 Unicode text", "utf-16be": "Big-endian UTF-16 Unicode text", "iso-8859-1": "ISO-8859 text", "unknown-8bit": "Non-ISO extended-ASCII text"}


def _described(mime: Column, code: Column, text: Column) -> Column:
    """XML or HTML, the kind of text, and its line ends."""
    kind = F.coalesce(F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])[code], F.concat(code, F.lit(" text")))
    version = F.coalesce(F.nullif(F.regexp_extract(F.substring(text, 1, 200), r"<\?xml\s+version\s*=\s*[\"']([\d.]+)", 1), F.lit("")), F.lit("1.0"))
    lead = F.when(mime == "application/xml", F.concat(F.lit("XML "), version, F.lit(" document, "))).when(mime == "text/html", "HTML document, ").otherwise("")
    ends = F.when(~F.contains(text, F.lit("\n")), ", with no line terminators").when(F.contains(text, F.lit("\r\n")), ", with CRLF line terminators").otherwise("")
    return F.concat(lead, kind, ends)


def file_type(content: Column) -> Column:
    """struct(mime, encoding, description, text, error) of raw bytes."""
    none = F.lit(None).cast("string")

    def judged(x: Column) -> Column:
        kind, code, text = x["kind"], x["own"]["encoding"], x["own"]["text"]
        broken = _structure(content, kind["mime"])
        of_text = mime_of_text(text)
        mime = F.when(content.isNull() | (F.octet_length(content) == 0) | broken.isNotNull(), BINARY).when(kind.isNotNull(), kind["mime"]).otherwise(of_text)
        known = F.when(kind["mime"] == "application/pdf", F.concat(F.lit("PDF document, version "), F.substring(content, 6, 3).cast("string"))).otherwise(kind["description"])
        told = F.when(content.isNull() | (F.octet_length(content) == 0), "empty").when(broken.isNotNull(), "data").when(kind.isNotNull(), known).otherwise(F.coalesce(_described(of_text, code, text), F.lit("data")))
        plain = F.coalesce(code, F.lit("binary"))
        error = F.when(content.isNull(), "no content").otherwise(F.coalesce(broken, none))
        return F.struct(mime.alias("mime"), plain.alias("encoding"), told.alias("description"), text.alias("text"), error.alias("error"))

    return _let(F.struct(_kind(content).alias("kind"), decoding(content).alias("own")), judged)


def mime_type(content: Column, known: Column | None = None) -> Column:
    """The type of raw bytes; a type already known stays."""
    out = file_type(content)["mime"]
    return out if known is None else F.coalesce(known, out)
