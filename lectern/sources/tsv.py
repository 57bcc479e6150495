"""Word tables of an OCR engine: tab-separated lines without quoting, read so that no line can swallow another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import once

# Fixed values of the format.
HEADER = ["level", "page_num", "block_num", "par_num", "line_num", "word_num", "left", "top", "width", "height", "conf", "text"]
WORD_LEVEL = "5"
BREAK = r"\r\n|[\r\n\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
NUMBERS = {"block_num": 2, "par_num": 3, "line_num": 4, "word_num": 5, "left": 6, "top": 7, "width": 8, "height": 9}


def _lines(text: Column) -> Column:
    """The lines of a text, without the terminators at its end. A text of plain line feeds, as most are, is not searched for others."""
    plain = F.split(F.when(F.endswith(text, F.lit("\n")), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text), "\n")
    every = F.split(F.regexp_replace(text, rf"({BREAK})$", ""), BREAK)
    return F.when(text.rlike(r"[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]") | F.endswith(text, F.lit("\n\n")) | (text == "\n"), every).otherwise(plain)


def _rows(files: DataFrame) -> DataFrame:
    """files: source, page, tsv -> a row for each line after the header, with its number (from 2) and fields; more tabs stay in the last field."""
    out = files.where("tsv <> ''").select("source", "page", F.posexplode(_lines(F.col("tsv"))).alias("at", "line")).where("at > 0")
    return once(out.select("source", "page", (F.col("at") + 1).alias("line_number"), "line"), f=F.split("line", "\t", len(HEADER)))


def _number(k: int) -> Column:
    field = F.trim(F.col("f")[k])
    return F.when(field == "", 0).otherwise(field.try_cast("int"))


def _is_word() -> Column:
    return (F.size("f") == len(HEADER)) & (F.col("f")[0] == WORD_LEVEL) & (F.trim(F.col("f")[11]) != "")


def _confidence() -> Column:
    """The confidence of a word's line: null if unknown, and nothing (an empty array) if it does not parse."""
    conf = F.col("f")[10]
    number = conf.try_cast("double")
    return F.when(conf.isin("", "-1"), F.array(F.lit(None).cast("double"))).when(number.isNull(), F.array().cast("array<double>")).otherwise(F.array(number))


def words(files: DataFrame) -> DataFrame:
    """Words of all files; a confidence that is empty or -1 is unknown, empty numbers are 0."""
    out = once(_rows(files).where(_is_word()), **{n: _number(k) for n, k in NUMBERS.items()}, known=_confidence(), text=F.trim(F.col("f")[11]))
    out = out.where(" AND ".join(f"{n} IS NOT NULL" for n in NUMBERS)).where("size(known) > 0")
    return out.select("source", "page", *NUMBERS, F.col("known")[0].alias("confidence"), "text")


def warnings(files: DataFrame) -> DataFrame:
    """What was not read as a word: empty files, other headers, lines of too few fields, word lines that do not parse. Each file is read once."""
    tsv, header = F.col("tsv"), "\t".join(HEADER)
    empty = F.coalesce(tsv, F.lit("")) == ""
    headed = (tsv == header) | F.startswith(tsv, F.lit(header + "\n")) | F.startswith(tsv, F.lit(header + "\r"))
    rows = files.select("source", "page", empty.alias("empty"), headed.alias("headed"), F.posexplode(F.when(empty, F.array(F.lit(""))).otherwise(_lines(tsv))).alias("at", "line"))
    rows = once(rows, f=F.split("line", "\t", len(HEADER)))
    first = F.when(F.col("empty"), "EMPTY_TSV").when(~F.col("headed"), "UNEXPECTED_TSV_HEADER")
    bad = F.size(_confidence()) == 0
    for k in NUMBERS.values():
        bad = bad | _number(k).isNull()
    code = F.when(F.col("at") == 0, first).when(F.size("f") != len(HEADER), "MALFORMED_TSV_ROW").when(_is_word() & bad, "INVALID_TSV_WORD_ROW")
    return once(rows, code=code).where("code IS NOT NULL").select("source", "page", "code", F.when(F.col("empty"), 0).otherwise(F.col("at") + 1).alias("line_number"))
