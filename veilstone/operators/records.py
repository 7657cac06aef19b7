"""Records: one row per source file, from scanned paths, extracted texts and OCR results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilstone.constants import DOCUMENT_EXTENSIONS, IMAGE_EXTENSIONS
from veilstone.functions.text import language, strip


def extension(path: Column) -> Column:
    """Last extension with its dot, as written; '' if the base name has none."""
    return F.regexp_extract(base_name(path), r"[^.](\.[^.]*)$", 1)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def route(path: Column) -> Column:
    """'image', 'document' or null for what no reader takes."""

    def ends(exts: list[str]) -> Column:
        low = F.lower(path)
        out = F.endswith(low, F.lit(exts[0]))
        for e in exts[1:]:
            out = out | F.endswith(low, F.lit(e))
        return out

    return F.when(ends(IMAGE_EXTENSIONS), "image").when(ends(DOCUMENT_EXTENSIONS), "document")


def build_records(files: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """files (keys, path) left-joined with texts (path, raw_text) to records.

    Images without a text are '[OCR FAILED: f]' and count as failed if their text starts with '[OCR'; documents
    with a blank text become '[EMPTY: f]' and failed. Files of other kinds are dropped.
    """
    joined = files.withColumn("route", route(F.col("path"))).filter("route IS NOT NULL").join(texts, "path", "left")
    f = base_name(F.col("path"))
    image = F.col("route") == "image"
    blank = F.coalesce(strip(F.col("raw_text")) == "", F.lit(True))
    raw = F.when(image, F.coalesce("raw_text", F.concat(F.lit("[OCR FAILED: "), f, F.lit("]")))).otherwise(F.when(blank, F.concat(F.lit("[EMPTY: "), f, F.lit("]"))).otherwise(F.col("raw_text")))
    return joined.select(
        *keys,
        f.alias("source_file"),
        F.when(image, "IMAGE").otherwise(F.upper(F.regexp_replace(extension(F.col("path")), r"\.", ""))).alias("file_type"),
        raw.alias("raw_text"),
        F.when(image, F.startswith(raw, F.lit("[OCR"))).otherwise(blank).alias("is_failed"),
    )


def with_language(records: DataFrame) -> DataFrame:
    """Adds language, that of the raw text."""
    return records.withColumn("language", language(F.col("raw_text")))
