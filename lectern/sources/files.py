"""Files as rows: scans, changed-path selection, JSON pages, JSON lines, archives, packed lots, page selections; and the sinks."""

from __future__ import annotations

import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of an archive's member at most, unpacked.
LARGEST_MEMBER = 2 << 30
# Fixed values of page selections.
FIRST_PREVIEWS, ROUND_PREVIEWS, SHARES, FULL_PREVIEW = 12, [100, 200, 300, 400], [0.1, 0.25, 0.5, 0.75, 0.9], 20
ZERO_COMMIT = "^0*$"
COMMIT = "^[0-9a-fA-F]{40,64}$"


def scan(spark: SparkSession, root: str, extension: str = ".pdf") -> DataFrame:
    """All files below root whose name ends so, in any case: path, content, size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.where(F.lower("path").endswith(extension.lower())).select("path", "content", F.col("length").alias("size_bytes"))


def changed_only(files: DataFrame, changes: DataFrame, event: str = "push", before: str = "") -> DataFrame:
    """Of a push with a known base only files that were added, modified or renamed; of anything else all. changes: path, status (A, M, R, D).

    A base that is no commit id is an error: a wrong history must not look like an empty change."""
    import re

    if event != "push" or re.match(ZERO_COMMIT, before):
        return files
    if not re.match(COMMIT, before):
        raise ValueError(f"not a commit: {before!r}")
    return files.join(changes.where(F.substring("status", 1, 1).isin("A", "M", "R")).select("path").distinct(), "path", "left_semi")


def json_pages(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """One JSON document a file; no file at all is an error."""
    pages = spark.read.schema(schema).option("multiLine", True).json(pattern)
    if pages.isEmpty():
        raise FileNotFoundError(pattern)
    return pages


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document a line, gzip or not; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.option("compression", "gzip").mode("errorifexists").json(path)


def write_json_document(row: DataFrame, path: str) -> None:
    """The one row of a frame as an indented JSON document, letters beyond ASCII as they are, in a folder of its own."""
    whole = row.limit(2).collect()
    if len(whole) != 1:
        raise ValueError("a document is one row")
    said = json.dumps(whole[0].asDict(recursive=True), ensure_ascii=False, indent=2, default=str)
    row.sparkSession.createDataFrame([(said,)], "value string").coalesce(1).write.mode("errorifexists").option("lineSep", "\n").text(path)


def report(row: DataFrame, title: str) -> str:
    """The one row of a frame as Markdown: a list of its fields, lists as lists below them."""
    (whole,) = row.limit(2).collect()
    lines = [f"# {title}", ""]
    for name, value in whole.asDict(recursive=True).items():
        lines += [f"* {name}:", *(f"  * {x}" for x in value)] if isinstance(value, list) else [f"* {name}: {value}"]
    return "\n".join(lines) + "\n"


def write_report(row: DataFrame, title: str, path: str) -> None:
    """A report for people and one for programs, side by side below path: report.md and report.json."""
    said = report(row, title)
    row.sparkSession.createDataFrame([(said,)], "value string").coalesce(1).write.mode("errorifexists").option("lineSep", "\n").text(f"{path}/report.md")
    write_json_document(row, f"{path}/report.json")


def zip_members(archives: DataFrame) -> DataFrame:
    """archives: path, content -> a row for each member: path, member, size_bytes, sha256, content. An archive that cannot be read, is encrypted or
    compressed in a way that is not known, or has a member of more than LARGEST_MEMBER bytes, gives one row without member and with its error.
    Archives are unpacked one at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for path, content in zip(frame["path"], frame["content"]):
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        if max((i.file_size for i in z.infolist()), default=0) > LARGEST_MEMBER:
                            raise OverflowError
                        rows = [(path, n, len(b), b, None) for n in z.namelist() if (b := z.read(n)) is not None]
                except (zipfile.BadZipFile, OSError, TypeError, zlib.error, RuntimeError, NotImplementedError, OverflowError, EOFError) as e:
                    rows = [(path, None, None, None, type(e).__name__)]
                yield pd.DataFrame(rows, columns=["path", "member", "size_bytes", "content", "error"])

    out = archives.select("path", "content").mapInPandas(run, "path string, member string, size_bytes long, content binary, error string")
    return out.withColumn("sha256", F.sha2("content", 256))


def unpacked_lots(lots: DataFrame) -> DataFrame:
    """lots: lot, packed (base64 text, or the raw bytes, of a 4-byte big-endian length and zlib data) -> lot, sql, error: a length that does not
    agree, or data that does not inflate, is an error, never a shorter text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for lot, raw in zip(frame["lot"], frame["raw"]):
                try:
                    (size,) = struct.unpack(">I", raw[:4])
                    unpacker = zlib.decompressobj()
                    data = unpacker.decompress(raw[4:], size + 1)  # no more than it says, and one byte to see that it says too little
                    if len(data) <= size and not unpacker.eof:
                        raise zlib.error
                    rows.append((lot, data.decode("utf-8"), None) if len(data) == size else (lot, None, "LENGTH_MISMATCH"))
                except (struct.error, TypeError):
                    rows.append((lot, None, "TOO_SHORT"))
                except (zlib.error, UnicodeDecodeError) as e:
                    rows.append((lot, None, type(e).__name__))
            yield pd.DataFrame(rows, columns=["lot", "sql", "error"])

    raw = F.try_to_binary(F.col("packed"), F.lit("base64")) if isinstance(lots.schema["packed"].dataType, T.StringType) else F.col("packed")
    return lots.select("lot", raw.alias("raw")).mapInPandas(run, "lot string, sql string, error string")


def selected_pages(documents: DataFrame, wanted: Column) -> DataFrame:
    """documents with n_pages -> one row for each wanted page that there is, once, in order."""
    pages = F.array_sort(F.array_distinct(F.filter(wanted, lambda p: p.between(1, F.col("n_pages")))))
    return documents.withColumn("page", F.explode(pages))


def preview_pages(n_pages: Column) -> Column:
    """Pages to render for a first look: the first dozen, round numbers, the last, and some shares of longer documents (rounded half to even)."""
    first = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(n_pages, F.lit(FIRST_PREVIEWS))))
    fixed = F.array(*[F.lit(p) for p in ROUND_PREVIEWS], n_pages)
    shares = F.when(n_pages > FULL_PREVIEW, F.array(*[F.greatest(F.lit(1), F.least(n_pages, F.bround(n_pages * s).cast("int"))) for s in SHARES])).otherwise(F.array().cast("array<int>"))
    every = F.concat(first, fixed.cast("array<int>"), shares)
    return F.array_sort(F.array_distinct(F.filter(every, lambda p: (p >= 1) & (p <= n_pages))))


def ocr_language(name: Column) -> Column:
    """eng if the file's name says ENG anywhere; any other name is an error: no language is guessed."""
    return F.when(F.contains(F.upper(name), F.lit("ENG")), F.lit("eng")).otherwise(F.raise_error(F.concat(F.lit("no OCR language for "), name)))


def write_verified(tables: dict[str, DataFrame], target: str, check) -> None:
    """Write tables below a temporary folder beside the target, check them as read again, and only then give the folder its name. An existing
    target is an error, a failed check leaves nothing."""
    spark = next(iter(tables.values())).sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(conf)
    if fs.exists(path):
        raise FileExistsError(target)
    draft = f"{target}.draft-{uuid.uuid4().hex}"
    draft_path = jvm.org.apache.hadoop.fs.Path(draft)
    try:
        for name, df in tables.items():
            df.write.parquet(f"{draft}/{name}")
        check({name: spark.read.parquet(f"{draft}/{name}") for name in tables})
        if not fs.rename(draft_path, path):
            raise OSError(f"cannot rename to {target}")
    finally:
        fs.delete(draft_path, True)
