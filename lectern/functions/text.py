"""Scalar text functions as Column expressions: all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The semantics of the evidence rules depend on them.
TOKEN_EDGES = ".,;:!?()[]{}\"'"
HEADING_EDGES = " .:-"
CLEAN_EDGES = " .:-|"
WORD_LIKE = "^[A-Za-z][A-Za-z'-]{2,}$"
STOP_HEADINGS = ["CONTENTS", "INTRODUCTION", "DESCRIPTION AND OPERATION", "ADJUSTMENTS", "REPAIRS"]
CONTENT_GROUPS = [
    "DESCRIPTION", "DESCRIPTION AND OPERATION", "ADJUSTMENT", "ADJUSTMENTS", "REPAIR", "REPAIRS", "GENERAL INFORMATION",
    "WIRE HARNESS AND EARTH LOCATIONS",
]
PHASES = {
    "remove": "remove", "refit": "refit", "refitting": "refit", "dismantle": "dismantle", "reassemble": "reassemble", "adjust": "adjust",
    "adjustment": "adjustment", "check": "check", "inspection": "inspection", "overhaul": "overhaul",
}
REPAIR_NUMBER = r"(?i)\bService\s+Repair\s+No\.?\s*([0-9]+(?:\.[0-9]+){1,4})\b"
STEP = r"^\s*(\d{1,3})\.\s*(.*)$"
BULLET = r"(?i)^\s*(?:[•●▪◦*-]|[eo]\s+)\s*(.*)$"
TRAILING_PAGE = r"\s+(\d{1,3})\s*$"
UNEVEN = r"[^ -~]|  |^ | \z"
TITLE_RATIO, HEADING_RATIO, LONGEST_TITLE, LEAST_LETTERS = 0.82, 0.72, 110, 4


def spaced(text: Column) -> Column:
    """Dashes made plain, runs of white space (as Unicode has it) one space, none at the ends; null is empty. Text of plain ASCII that has no
    other space than single ones between words, as most has, is told by one search and stays as it is."""
    plain = F.translate(text, "–—", "--")
    return F.when(text.isNull(), "").when(~text.rlike(UNEVEN), text).otherwise(F.trim(F.regexp_replace(plain, r"(?U)[\s\x1c-\x1f]+", " ")))


def _even(text: Column, even: bool) -> Column:
    """The functions below take even=True for text that is spaced already, as a column that is used often should be."""
    return text if even else spaced(text)


def stripped(text: Column, edges: str) -> Column:
    return F.btrim(text, F.lit(edges))


def letters(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}]+", "")


def upper_ratio(text: Column) -> Column:
    """Share of capitals among letters; 0 without letters."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))
    return capitals / F.greatest(F.lit(1), F.length(letters(text)))


def _capital(text: Column, least: float) -> Column:
    """Whether text is no longer than a title, has as many letters as one, and this share of capitals (so one at least: most lines have none)."""
    return (F.length(text) <= LONGEST_TITLE) & text.rlike(r"\p{Lu}") & (F.length(letters(text)) >= LEAST_LETTERS) & (upper_ratio(text) >= least)


def clean_heading(text: Column, even: bool = False) -> Column:
    s = F.regexp_replace(_even(text, even), r"^[^A-Za-z0-9]+", "")
    s = F.reverse(F.regexp_replace(F.reverse(s), r"^[^A-Za-z0-9)./&+-]+", ""))  # a search for the end of the text would begin at each character
    return stripped(s, CLEAN_EDGES)


def is_title(text: Column, even: bool = False) -> Column:
    s = _even(text, even)
    return _capital(s, TITLE_RATIO) & ~F.upper(s).isin(STOP_HEADINGS)


def is_heading(text: Column, clean: bool = False) -> Column:
    """clean: text is a cleaned heading already."""
    s = text if clean else clean_heading(text)
    return _capital(s, HEADING_RATIO) & (F.upper(s) != "CONTENTS")


def token(text: Column) -> Column:
    """A word as the lexicon knows it: no punctuation at the ends, lower case."""
    return F.lower(stripped(F.coalesce(text, F.lit("")), TOKEN_EDGES))


def is_word_like(normal: Column) -> Column:
    return normal.rlike(WORD_LIKE)


def phase_source(text: Column, even: bool = False) -> Column:
    """The phase heading's own form if the whole line is one, else null."""
    form = F.lower(stripped(_even(text, even), HEADING_EDGES))
    return F.when(form.isin(list(PHASES)), form)


def phase_label(source: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in PHASES.items() for x in pair]), source)


def repair_number(text: Column, even: bool = False) -> Column:
    s = _even(text, even)
    found = F.when(F.contains(F.lower(s), F.lit("service")), F.regexp_extract(s, REPAIR_NUMBER, 1)).otherwise("")
    return F.when(found != "", found)


def step_number(text: Column, even: bool = False) -> Column:
    s = _even(text, even)
    return F.when(F.substring(s, 1, 1).between("0", "9"), F.regexp_extract(s, STEP, 1).try_cast("int"))


def step_body(text: Column, even: bool = False) -> Column:
    return F.trim(F.regexp_extract(_even(text, even), STEP, 2))


def is_bullet(text: Column, even: bool = False) -> Column:
    return _even(text, even).rlike(BULLET)


def bullet_body(text: Column, even: bool = False) -> Column:
    return F.trim(F.regexp_extract(_even(text, even), BULLET, 1))


def is_standalone(text: Column, heading: str, even: bool = False) -> Column:
    return F.upper(stripped(_even(text, even), HEADING_EDGES)) == heading


def noise_ratio(text: Column) -> Column:
    solid = F.regexp_replace(text, r"(?U)\s", "")
    return F.lit(1.0) - F.length(letters(text)) / F.greatest(F.lit(1), F.length(solid))


def trailing_page(text: Column) -> Column:
    return F.regexp_extract(text, TRAILING_PAGE, 1).try_cast("int")


def ascii_lower(text: Column) -> Column:
    """Only A-Z: other letters keep their case, as the search rule asks."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def file_stem(path: Column) -> Column:
    name = F.regexp_extract(path, r"([^/\\]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def normal_key(name: Column) -> Column:
    """a-z and 0-9 of a name, lower-cased."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def safe_filename(name: Column) -> Column:
    return F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_")


def is_sha256(text: Column) -> Column:
    return F.lower(text).rlike("^[0-9a-f]{64}$")


def review_id(sha: Column, page: Column, code: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", sha, page, code), 256), 1, 24)


def git_blob_sha1(content: Column) -> Column:
    head = F.encode(F.concat(F.lit("blob "), F.length(content).cast("string"), F.char(F.lit(0))), "utf-8")
    return F.sha1(F.concat(head, content))


def is_safe_path(path: Column) -> Column:
    """Relative, with / or \\ between parts, none of them empty, . or .., and no colon."""
    parts = F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/")
    return (path != "") & ~path.contains(":") & F.forall(parts, lambda p: ~p.isin("", ".", ".."))


def is_allowed_member(name: Column) -> Column:
    return name.rlike(r"^(manifest\.json|source/document\.pdf|data/knowledge\.sqlite|ocr/page-[0-9]+\.tsv\.gz)$")


def finite(value: Column) -> Column:
    """A number, or null for what is none or not finite."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def expanded_references(value: Column, widest: int = 12) -> Column:
    """`DOC:a.b, c.d-e.f` as an array of single references, each once, in order.

    A range of one major number and at most `widest` steps is spelled out, other ranges stay as written, what does not parse is its own only
    reference, and empty text has none."""
    text = F.trim(value)
    document = F.regexp_extract(text, r"^([A-Za-z0-9_]+):", 1)
    parsed = text.rlike(r"^[A-Za-z0-9_]+:\d+\.\d+(?:\s*[,;-]\s*\d+\.\d+)*$")
    parts = F.split(F.regexp_replace(text, r"^[A-Za-z0-9_]+:", ""), r"\s*[,;]\s*")
    pattern = r"^(\d+)\.(\d+)-(\d+)\.(\d+)$"
    group = lambda part, k: F.regexp_extract(part, pattern, k).try_cast("bigint")

    def spread(part: Column) -> Column:
        first, last = group(part, 2), group(part, 4)
        short = part.rlike(pattern) & (group(part, 1) == group(part, 3)) & (last - first).between(0, widest)
        numbers = F.sequence(F.coalesce(first, F.lit(0)), F.when(short, last).otherwise(F.coalesce(first, F.lit(0))))
        return F.when(short, F.transform(numbers, lambda n: F.concat(document, F.lit(":"), group(part, 1), F.lit("."), n))).otherwise(F.array(F.concat(document, F.lit(":"), part)))

    spelled = F.array_distinct(F.flatten(F.transform(parts, spread)))
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).when(parsed, spelled).otherwise(F.array(text))
