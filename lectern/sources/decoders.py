"""Decoding of PDF bytes and recognition of page images: optional programs, one call for each document or page, in parallel over rows."""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile
from collections.abc import Iterator
from importlib.util import find_spec

import pandas as pd
from pyspark.sql import DataFrame

PAGE_SCHEMA = "path string, page int, width double, height double, rotation int, text string, images int, vectors int, links int, annotations int, error string"
DPI, SEGMENTATION = 300, 3


def can_decode() -> bool:
    return find_spec("pymupdf") is not None


def can_recognise() -> bool:
    return shutil.which("tesseract") is not None


def native_pages(files: DataFrame) -> DataFrame:
    """files: path, content -> a row for each page. A locked or broken file gives one row with its error. Needs the pymupdf package."""
    if not can_decode():
        raise RuntimeError("PDF decoding needs the pymupdf package")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pymupdf

        for frame in batches:
            rows = []
            for path, content in zip(frame["path"], frame["content"]):
                try:
                    with pymupdf.open(stream=content, filetype="pdf") as doc:
                        if doc.needs_pass:
                            raise ValueError("PASSWORD_REQUIRED")
                        for k, page in enumerate(doc, 1):
                            marks = sum(1 for _ in page.annots() or ())
                            rows.append((path, k, page.rect.width, page.rect.height, page.rotation, page.get_text(), len(page.get_images()), len(page.get_drawings()), len(page.get_links()), marks, None))
                except Exception as e:
                    rows.append((path, None, None, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in PAGE_SCHEMA.split(", ")])

    return files.select("path", "content").mapInPandas(run, PAGE_SCHEMA)


def recognised(images: DataFrame, language: str = "eng") -> DataFrame:
    """images: source, page, image (bytes of a picture) -> source, page, tsv, for lectern.sources.tsv. Needs the tesseract program."""
    if not can_recognise():
        raise RuntimeError("recognition needs the tesseract program")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for image in frame["image"]:
                with tempfile.TemporaryDirectory() as d:  # one call's input; nothing of it is read elsewhere
                    name = os.path.join(d, "page.png")
                    with open(name, "wb") as f:
                        f.write(image)
                    done = subprocess.run(["tesseract", name, "stdout", "-l", language, "--dpi", str(DPI), "--psm", str(SEGMENTATION), "tsv"], capture_output=True, check=True)
                    out.append(done.stdout.decode("utf-8", "replace"))
            yield pd.DataFrame({"source": frame["source"], "page": frame["page"], "tsv": out})

    return images.select("source", "page", "image").mapInPandas(run, images.select("source", "page").schema.add("tsv", "string"))
