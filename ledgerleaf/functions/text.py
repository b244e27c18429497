"""Column functions over strings: classification, normal forms, keys and flags. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SHORT_TEXT_CHARS = 500
BROKEN_RATIO = 0.3
BROKEN_CHARS = "[\\x00-\\x08\\x0b-\\x1f\\x7f-\\x9f\\ufffd]"
OCR_LEAST_CHARS = 100
PRODUCERS = ("word", "itext", "oz", "adobe", "gaaiho", "ezpdf", "foxit")
DOT_LEADER = r"(?U)\s*[.·ㆍ…]{4,}\s*\d*\s*$"


def strip(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def without_spaces(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s", "")


def digit_mask(line: Column) -> Column:
    """The stripped line, each run of digits one ``#``: equal for lines that differ in numbers only."""
    return F.regexp_replace(strip(line), r"\d+", "#")


def normal_title(title: Column) -> Column:
    """Digits, Latin letters and Hangul syllables only."""
    return F.regexp_replace(title, "[^0-9A-Za-z가-힣]", "")


def report_kind(name: Column, kinds: Sequence[tuple[str, str]], other: str = "other") -> Column:
    """``struct(kind, is_correction)``: a leading bracket marks a correction; after all leading brackets the first
    matching prefix of ``kinds`` (prefix, kind) decides."""
    bare = F.regexp_replace(name, r"^(\[[^\]]*\])+", "")
    kind = F.lit(other)
    for prefix, value in reversed(kinds):
        kind = F.when(bare.startswith(prefix), F.lit(value)).otherwise(kind)
    return F.struct(kind.alias("kind"), name.startswith("[").alias("is_correction"))


def first_contained(text: Column, words: Sequence[str] = PRODUCERS, other: str = "other") -> Column:
    """The first of ``words`` that the lower-cased text contains."""
    out = F.lit(other)
    for word in reversed(words):
        out = F.when(F.lower(text).contains(word), F.lit(word)).otherwise(out)
    return out


def quality_flags(text: Column) -> Column:
    """SHORT_TEXT below 500 characters; BROKEN_CHARS from 30 % control or replacement characters."""
    share = F.regexp_count(text, F.lit(BROKEN_CHARS)) / F.length(text)
    return F.array_compact(
        F.array(
            F.when(F.length(text) < SHORT_TEXT_CHARS, F.lit("SHORT_TEXT")),
            F.when((F.length(text) > 0) & (share >= BROKEN_RATIO), F.lit("BROKEN_CHARS")),
        )
    )


def needs_ocr(text: Column) -> Column:
    return F.length(without_spaces(text)) < OCR_LEAST_CHARS


def structure_status(has_sections: Column, tables_status: Column) -> Column:
    return F.when(~has_sections, "UNAVAILABLE").when(tables_status == "OK", "AVAILABLE").otherwise("PARTIAL")


def extract_status(reused: Column, supported: Column, error: Column, text: Column, violations: Column) -> Column:
    """The first that applies: REUSED, UNSUPPORTED, EXTRACT_FAILED, OCR_REQUIRED, EXTRACT_FAILED (rules), EXTRACT_OK."""
    return (
        F.when(reused, "REUSED").when(~supported, "UNSUPPORTED").when(error.isNotNull(), "EXTRACT_FAILED")
        .when(needs_ocr(text), "OCR_REQUIRED").when(violations > 0, "EXTRACT_FAILED").otherwise("EXTRACT_OK")
    )


def text_slice(text: Column, start: Column, end: Column) -> Column:
    """Code points [start, end); null for a null range."""
    return F.when(start.isNotNull() & end.isNotNull(), F.substring(text, start + 1, end - start))


def date_of_key(key: Column, kind: Column | None = None, dated: str | None = None) -> Column:
    """The day that a key's first eight digits name, null if they are none; with ``kind``, only for keys of kind ``dated``."""
    day = F.try_to_timestamp(F.regexp_extract(key, r"^(\d{8})", 1), F.lit("yyyyMMdd")).cast("date")
    return day if kind is None else F.when(kind == dated, day)


def percent_decode(text: Column) -> Column:
    """Percent escapes decoded; a plus sign stays one."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def code_scheme(code: Column) -> Column:
    """Scheme of a standard code by its first three characters."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for p in ("K55", "KR5", "KRM") for x in (p, p))), F.substring(code, 1, 3)), F.lit("OTHER"))


def risk_grade(text: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(r"(\d)등급"), 1), F.lit(1)).cast("int")


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether the text contains one of the words; false for null."""
    out = F.lit(False)
    for word in words:
        out = out | F.contains(text, F.lit(word))
    return F.coalesce(out, F.lit(False))


def section_label(kind: Column, part: Column, seq: Column, number: Column) -> Column:
    """Name under which a section is quoted: the summary, the cover (first other section) or a section of part 2."""
    return (
        F.when(kind == "summary", "요약정보")
        .when((kind == "other") & (seq == 1), "표지")
        .when((kind == "body") & (part == 2), F.concat(F.lit("제2부 "), number, F.lit("절")))
    )


def json_value(value: Column) -> Column:
    """A scalar as canonical JSON: strings quoted and escaped, numbers and truth values bare, null as ``null``."""
    wrapped = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def canonical_key(*fields: Column) -> Column:
    """SHA-256 of the fields as a JSON array without spaces; nulls keep their place."""
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *map(json_value, fields)), F.lit("]")), 256)


#: What can become of a request (fixed values).
OUTCOMES = ("SUCCESS", "EMPTY", "RETRYABLE_FAILED", "RATE_LIMITED", "CONFIG_ERROR", "PERMANENT_FAILED")


def http_class(status: int) -> str:
    """What an HTTP status means for a fetch."""
    known = {200: "SUCCESS", 401: "CONFIG_ERROR", 403: "CONFIG_ERROR", 429: "RATE_LIMITED"}
    return known.get(status, "RETRYABLE_FAILED" if status >= 500 else "PERMANENT_FAILED")


def http_outcome(status: Column) -> Column:
    """``http_class`` of a column; no status, as after a time-out, may be tried again."""
    return (
        F.when(status == 200, "SUCCESS").when(status.isin(401, 403), "CONFIG_ERROR").when(status == 429, "RATE_LIMITED")
        .when((status >= 500) | status.isNull(), "RETRYABLE_FAILED").otherwise("PERMANENT_FAILED")
    )


def call_cost(model: Column, tokens_in: Column, tokens_out: Column, prices: dict[str, tuple[float, float]]) -> Column:
    """Cost of a model call from (input, output) prices per million tokens; null for an unknown model."""
    out = F.lit(None).cast("double")
    for name, (a, b) in prices.items():
        out = F.when(model == name, (tokens_in * F.lit(a) + tokens_out * F.lit(b)) / F.lit(1e6)).otherwise(out)
    return out


def hex_color(color: Column) -> Column:
    """``#rrggbb`` of 1 (gray), 3 (RGB) or 4 (CMYK) components between 0 and 1; halves round to even; else null."""
    byte = lambda x: F.lpad(F.lower(F.hex(F.bround(x * 255, 0).cast("int"))), 2, "0")
    at = lambda k: F.get(color, F.lit(k))
    gray = F.concat(F.lit("#"), byte(at(0)), byte(at(0)), byte(at(0)))
    rgb = F.concat(F.lit("#"), byte(at(0)), byte(at(1)), byte(at(2)))
    ink = [(1 - at(k)) * (1 - at(3)) for k in range(3)]
    return F.when(F.size(color) == 1, gray).when(F.size(color) == 3, rgb).when(F.size(color) == 4, F.concat(F.lit("#"), *map(byte, ink)))


def is_magic(content: Column, kind: str) -> Column:
    """Whether binary content starts as a PDF or ZIP file does."""
    return F.substring(F.hex(content), 1, 10 if kind == "pdf" else 8) == {"pdf": "255044462D", "zip": "504B0304"}[kind]


def undoubled(text: Column) -> Column:
    """Repairs headings printed twice over: if each of two or more words has every character doubled, halve them."""
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    half = F.transform(words, lambda w: F.regexp_replace(w, r"(?s)(.)\1", "$1"))
    doubled = F.forall(words, lambda w: w.rlike(r"(?s)^(?:(.)\1)+$"))
    return F.when((F.size(words) >= 2) & doubled, F.array_join(half, " ")).otherwise(text)
