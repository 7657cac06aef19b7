"""Readers of source files: paths and contents to texts, in Arrow batches.

A reader that fails returns the lines it had gathered, with a warning; files of other kinds are dropped. PDF and image
texts need a registered back-end: bytes -> text, for PDFs also the texts of the pages one by one. Without one PDFs read
as empty and images get no row, which records report as '[EMPTY: f]' and '[OCR FAILED: f]'. Several back-ends of a kind
are asked in order until one gives a text.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.constants import DOCUMENT_EXTENSIONS, IMAGE_EXTENSIONS
from veilstone.functions.text import let, sanitise
from veilstone.operators.backends import log, within
from veilstone.operators.records import extension, route

IMAGES_TOGETHER, OCR_SECONDS = 3, 600  # images in one call of a back-end, and the time it has
MAX_SIDE, LEAST_SIDE = 2000, 800  # longer side of an image that is read, and where halving it ends

BLOCKS = {"p", "div", "td", "tr", "h1", "h2", "h3", "span"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer"}
UNREAD = {"script", "style", "template"}
Read = Callable[[bytes], "str | Iterable[str]"]
_backends: dict[str, list[Read]] = {}


def register_backend(kind: str, *reads: Read) -> None:
    """kind: 'pdf' or 'image'; reads are asked in order until one gives a text."""
    _backends[kind] = list(reads)


def unregister_backend(kind: str) -> None:
    _backends.pop(kind, None)


class _Blocks(HTMLParser):
    """Texts of the block elements in document order. An element that isn't closed holds all that follows."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str] | None]] = []
        self.blocks: list[list[str]] = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        mine = [] if tag in BLOCKS else None
        if mine is not None:
            self.blocks.append(mine)
        self.open.append((tag, mine))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        data = data.strip()
        if data and not any(t in UNREAD for t, _ in self.open):
            for _, mine in self.open:
                if mine is not None:
                    mine.append(data)


def html_lines(content: bytes) -> Iterator[str]:
    parser = _Blocks()
    try:
        parser.feed(content.decode("utf-8", "ignore"))
        parser.close()
    except Exception as e:  # noqa: BLE001 - what was read so far counts
        log.warning("HTML reader failed: %s", e)
    for block in parser.blocks:
        text = "".join(block)
        if len(text) > 5:
            yield text


_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_lines(content: bytes) -> Iterator[str]:
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{_WORD}body")

    def text(e) -> str:
        out = []
        for x in e.iter():
            if x.tag == f"{_WORD}t":
                out.append(x.text or "")
            elif x.tag == f"{_WORD}tab":
                out.append("\t")
            elif x.tag in (f"{_WORD}br", f"{_WORD}cr"):
                out.append("\n")
        return "".join(out)

    for p in body.findall(f"{_WORD}p"):
        if t := text(p).strip():
            yield t
    for table in body.findall(f"{_WORD}tbl"):
        for row in table.findall(f"{_WORD}tr"):
            cells = ["\n".join(text(p) for p in c.findall(f"{_WORD}p")).strip() for c in row.findall(f"{_WORD}tc")]
            if line := " | ".join(c for c in cells if c):
                yield line


def plain_lines(text: str) -> Iterator[str]:
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        if line.strip():
            yield line.strip()


def pdf_lines(content: bytes, chain: list[Read]) -> Iterator[str]:
    """Lines of the pages in order; a back-end is left for the next only if it gave no line."""
    for read in chain:
        some = False
        pages = read(content)
        for page in [pages] if isinstance(pages, str) else pages or ():
            for line in plain_lines(page or ""):
                some = True
                yield line
        if some:
            return


def read_document(kind: str, content: bytes, backends: dict[str, list[Read]]) -> str:
    lines: list[str] = []
    try:
        if kind in (".html", ".htm"):
            source = html_lines(content)
        elif kind == ".docx":
            source = docx_lines(content)
        elif kind == ".pdf":
            source = pdf_lines(content, backends.get("pdf", []))
        else:
            source = plain_lines(content.decode("utf-8", "ignore"))
        for line in source:
            lines.append(line)
    except Exception as e:  # noqa: BLE001 - what was read so far counts
        log.warning("reader of %s failed after %d lines: %s", kind, len(lines), e)
    return "\n".join(lines)


def scan_files(spark: SparkSession, root: str, modified_after: str | None = None) -> DataFrame:
    """(path, content) of all files under root in formats that are read; empty if root doesn't exist.

    Names are matched before any content is read; modified_after ('2026-01-31T00:00:00') leaves out older files.
    A file is one value, so files near 2 GB aren't read: Spark refuses them.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], "path string, content binary")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name_pattern())
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(root).select("path", "content").filter(route(F.col("path")).isNotNull())


def name_pattern() -> str:
    """Glob of the names that are read, in any case of letters."""
    any_case = ("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e) for e in IMAGE_EXTENSIONS + DOCUMENT_EXTENSIONS)
    return "*{" + ",".join(any_case) + "}"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(image, out) of an OCR manifest, a JSON list of tasks; an error if it names none."""
    tasks = spark.read.schema("image string, out string").option("multiLine", True).json(path).filter("image IS NOT NULL")
    if tasks.isEmpty():
        raise ValueError(f"no tasks in {path}")
    return tasks


def exchanged_texts(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) of text files that an OCR worker wrote: byte order mark dropped, bad bytes replaced, stripped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root)

    @F.pandas_udf("string")
    def decoded(content: pd.Series) -> pd.Series:
        return content.map(lambda b: bytes(b).decode("utf-8-sig", "replace").strip())

    return files.select("path", decoded("content").alias("text"))


def fitted_size(width: Column, height: Column, most: int = MAX_SIDE) -> Column:
    """struct(width, height) of an image whose longer side is brought down to most; smaller images stay."""
    long = F.greatest(width, height)
    scale = F.lit(float(most)) / long
    return F.when(long > most, F.struct(F.floor(width * scale).cast("int").alias("width"), F.floor(height * scale).cast("int").alias("height"))).otherwise(
        F.struct(width.cast("int").alias("width"), height.cast("int").alias("height"))
    )


def by_smaller_images(read: Callable[[bytes, int], str]) -> Callable[[bytes], str]:
    """A back-end that reads an image at MAX_SIDE, and at half of it as long as memory doesn't do and the side is over LEAST_SIDE."""

    def run(content: bytes) -> str:
        side = MAX_SIDE
        while True:
            try:
                return read(content, side)
            except MemoryError:
                if side <= LEAST_SIDE:
                    return ""
                side //= 2

    return run


def read_images(names: list[str], contents: list[bytes], chain: list[Callable[[bytes], str]]) -> list[str]:
    """Texts of images: the first back-end of the chain that gives one; sentinels where none does or time is up.

    Images go in groups of IMAGES_TOGETHER, which have OCR_SECONDS together; of a group that takes longer the images
    not read by then have failed.
    """
    out: list[str] = []
    for at in range(0, len(names), IMAGES_TOGETHER):
        done: dict[int, str] = {}

        def group(part: list[bytes], done: dict[int, str] = done) -> None:
            for i, content in enumerate(part):
                done[i] = first_text(content, chain)

        try:
            within(OCR_SECONDS, group, contents[at : at + IMAGES_TOGETHER])
        except Exception as e:  # noqa: BLE001
            log.warning("OCR group failed: %s", e)
        for i, name in enumerate(names[at : at + IMAGES_TOGETHER]):
            out.append(f"[OCR FAILED: {name}]" if i not in done else done[i] or f"[OCR EMPTY: {name}]")
    return out


def first_text(content: bytes, chain: list[Callable[[bytes], str]]) -> str:
    for read in chain:
        try:
            text = (read(content) or "").lstrip("﻿").strip()
        except Exception as e:  # noqa: BLE001 - the next one is asked
            log.warning("OCR back-end failed: %s", e)
            continue
        if text:
            return text
    return ""


def read_texts(files: DataFrame) -> DataFrame:
    """(path, raw_text) of files (path, content). Images have no row if no back-end is registered; their texts are sanitised."""
    chains = {k: list(v) for k, v in _backends.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths, kinds, contents, is_image = (c.to_pylist() for c in b.columns)
            images = [i for i, x in enumerate(is_image) if x]
            docs = [i for i, x in enumerate(is_image) if not x]
            rows = [(paths[i], read_document(kinds[i], contents[i] or b"", chains), False) for i in docs]
            if "image" in chains:
                names = [paths[i].rsplit("/", 1)[-1] for i in images]
                rows += [(paths[i], t, True) for i, t in zip(images, read_images(names, [contents[i] or b"" for i in images], chains["image"]))]
            cols = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.bool_())], names=["path", "text", "is_image"])

    rows = files.select("path", F.lower(extension(F.col("path"))).alias("kind"), "content", (route(F.col("path")) == "image").alias("is_image"))
    read = rows.mapInArrow(run, "path string, text string, is_image boolean")
    # what is left of an image's text is empty if it held nothing but markup
    failed = F.startswith("text", F.lit("[OCR FAILED: "))
    name = F.substring_index("path", "/", -1)
    clean = let(sanitise(F.col("text")), lambda t: F.when(t == "", F.concat(F.lit("[OCR EMPTY: "), name, F.lit("]"))).otherwise(t))
    return read.select("path", F.when(F.col("is_image") & ~failed, clean).otherwise(F.col("text")).alias("raw_text"))
