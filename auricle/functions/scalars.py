"""Column functions. All run in the JVM; none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that text stripping removes, as a Java character class.
STRIP_CLASS = r"[\s\x1c-\x1f]"
# Number spellings accepted when the type of a text cell is inferred.
INT_CELL = r"^(?U)[\s\x1c-\x1f]*[+-]?[0-9]+(_[0-9]+)*[\s\x1c-\x1f]*$"
FLOAT_CELL = (
    r"^(?U)[\s\x1c-\x1f]*[+-]?([0-9]+(_[0-9]+)*\.([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)"
    r"([eE][+-]?[0-9]+(_[0-9]+)*)?[\s\x1c-\x1f]*$"
)
FLAG_CATEGORY = "reportable_content"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- JSON -------------------------------------------------------------------


def json_text(document: Column | str, key: str) -> Column:
    """Text of one top-level key, null when absent."""
    return F.get_json_object(col(document), f"$.{key}")


def json_int(document: Column | str, key: str) -> Column:
    return json_text(document, key).try_cast("int")


def json_has(document: Column | str, key: str) -> Column:
    return json_text(document, key).isNotNull()


def row_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns))


def json_row(document: Column | str, schema: str) -> Column:
    return F.from_json(col(document), schema)


def json_quote(text: Column) -> Column:
    """A text as a JSON string literal, escapes included."""
    wrapped = F.to_json(F.struct(text.alias("v")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


# --- time -------------------------------------------------------------------


def day(moment: Column | str) -> Column:
    return F.to_date(col(moment))


def hour(moment: Column | str) -> Column:
    """Start of the hour. date_trunc returns a zoned timestamp, so cast back."""
    return F.date_trunc("hour", col(moment)).cast("timestamp_ntz")


def hour_label(moment: Column | str) -> Column:
    return F.date_format(col(moment), "HH:mm")


def date_text(moment: Column | str) -> Column:
    return F.date_format(col(moment), "yyyy-MM-dd")


def batch_stamp(moment: Column | str) -> Column:
    return F.date_format(col(moment), "yyyyMMdd-HHmmss")


def iso_utc(moment: Column | str) -> Column:
    """ISO time with microseconds and a trailing Z."""
    return F.date_format(col(moment), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def epoch_text(seconds: Column | str) -> Column:
    """Whole epoch seconds as UTC text (the session zone is UTC)."""
    return F.date_format(F.timestamp_seconds(F.floor(col(seconds))), "yyyy-MM-dd HH:mm:ss")


# --- paths and text ---------------------------------------------------------


def strip_extension(name: Column | str) -> Column:
    """Drop the last extension; a name that is only an extension becomes empty."""
    return F.regexp_replace(col(name), r"\.[^.]+$", "")


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def path_stem(path: Column | str) -> Column:
    """Base name without its last suffix; a leading dot is part of the stem, as is a last dot."""
    return F.regexp_replace(base_name(path), r"(?s)^(.+)\.[^.]+$", "$1")


def has_suffix(name: Column | str, suffix: str) -> Column:
    return F.lower(col(name)).endswith(suffix)


def strip(text: Column | str) -> Column:
    """Remove leading and trailing white space of every kind, line breaks included."""
    return F.regexp_replace(col(text), rf"(?U)^{STRIP_CLASS}+|{STRIP_CLASS}+\z", "")


def is_blank(text: Column | str) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(~F.regexp_like(col(text), F.lit(rf"(?U)[^\s\x1c-\x1f]")), F.lit(True))


def pad_right(text: Column | str, width: int) -> Column:
    """Pad with blanks up to a width; longer text stays whole."""
    value = col(text)
    return F.when(F.length(value) < width, F.rpad(value, width, " ")).otherwise(value)


def preview(text: Column | str, width: int) -> Column:
    return F.substring(col(text), 1, width)


def composite_key(*parts: Column | str, separator: str = ":") -> Column:
    return F.concat_ws(separator, *[col(p) for p in parts])


def value_or(value: Column | str, default: str) -> Column:
    """Default for null and for empty text."""
    return F.coalesce(F.nullif(col(value), F.lit("")), F.lit(default))


# --- numbers ----------------------------------------------------------------


def clamp_unit(value: Column | str) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), col(value)))


def round_half_up(value: Column | str, places: int) -> Column:
    """Decimal rounding, half away from zero, free of binary-fraction surprises."""
    return F.round(col(value).cast("decimal(30,12)"), places)


def percent(part: Column | str, whole: Column | str) -> Column:
    return F.lit(100.0) * col(part) / F.greatest(col(whole), F.lit(1))


def kib(size: Column | str) -> Column:
    return col(size) / F.lit(1024.0)


def mib(size: Column | str) -> Column:
    return col(size) / F.lit(1024.0 * 1024)


def gib(size: Column | str) -> Column:
    return col(size) / F.lit(1024.0 * 1024 * 1024)


def as_score(value: Column | str) -> Column:
    """Score as stored by the review tables; null where it does not fit."""
    return col(value).try_cast("decimal(10,9)")


# --- cells of text metadata -------------------------------------------------


def _digits(cell: Column) -> Column:
    return F.regexp_replace(cell, r"(?U)[\s\x1c-\x1f_]", "")


def _has_digit(cell: Column) -> Column:
    """A quick look that spares most cells the long patterns."""
    return cell.rlike("[0-9]")


def cell_kind(cell: Column | str) -> Column:
    """'int', 'float' or 'text' for a cell; integers may have any number of digits."""
    value = col(cell)
    dotted = value.contains(".")
    return (
        F.when(~_has_digit(value), "text")
        .when(dotted & value.rlike(FLOAT_CELL), "float")
        .when(~dotted & value.rlike(INT_CELL), "int")
        .otherwise("text")
    )


def cell_int(cell: Column | str) -> Column:
    """The integer of a cell; null beyond 64 bits, where `cell_json` keeps its digits."""
    value = col(cell)
    return F.when(_has_digit(value) & value.rlike(INT_CELL), _digits(value)).try_cast("bigint")


def cell_float(cell: Column | str) -> Column:
    value = col(cell)
    return F.when(_has_digit(value) & value.rlike(FLOAT_CELL), _digits(value)).try_cast("double")


def _plain_integer(cell: Column) -> Column:
    unsigned = F.regexp_replace(_digits(cell), r"^\+", "")
    return F.regexp_replace(unsigned, "^(-?)0+(?=[0-9])", "$1")


def cell_json(cell: Column) -> Column:
    """A cell as JSON: number, string, or null for a missing cell."""
    kind = cell_kind(cell)
    number = cell_float(cell)
    finite = number.isNotNull() & (F.abs(number) <= F.lit(1.7976931348623157e308))
    return (
        F.when(cell.isNull(), "null")
        .when(kind == "int", F.coalesce(cell_int(cell).cast("string"), _plain_integer(cell)))
        .when((kind == "float") & finite, number.cast("string"))
        .otherwise(json_quote(cell))
    )


# --- classification ---------------------------------------------------------


def render_prompt(template: Column | str, text: Column | str) -> Column:
    """The text put into the template's slot; doubled braces of the template become single.

    Marks stand in for the braces and the slot, and the text goes in last, so nothing inside the
    text is replaced.
    """
    marked = col(template)
    for token, mark in (("{{", "\u0001"), ("}}", "\u0002"), ("{content_text}", "\u0003")):
        marked = F.replace(marked, F.lit(token), F.lit(mark))
    for mark, brace in (("\u0001", "{"), ("\u0002", "}")):
        marked = F.replace(marked, F.lit(mark), F.lit(brace))
    return F.replace(marked, F.lit("\u0003"), col(text))


def first_digit(response: Column | str) -> Column:
    """The first 0 or 1 of a model response, empty when there is none."""
    return F.regexp_extract(F.coalesce(col(response), F.lit("")), "[01]", 0)


def verdict(response: Column | str, text: Column | str | None = None) -> Column:
    """struct(flagged, flag_score, flag_category); blank text is never flagged."""
    flagged = first_digit(response) == "1"
    if text is not None:
        flagged = flagged & ~is_blank(text)
    return F.struct(
        flagged.alias("flagged"),
        F.when(flagged, 1.0).otherwise(0.0).alias("flag_score"),
        F.when(flagged, FLAG_CATEGORY).alias("flag_category"),
    )


def status_for(flagged: Column | str) -> Column:
    return F.when(col(flagged), "flagged").otherwise("transcribed")


# --- object keys ------------------------------------------------------------


def processed_key(date: Column | str, audio_id: Column | str, filename: Column | str) -> Column:
    """processed/{date}/{stem}.opus; the id stands in when there is no file name."""
    stem = F.when(
        F.coalesce(F.length(col(filename)), F.lit(0)) > 0, path_stem(filename)
    ).otherwise(col(audio_id).cast("string"))
    return F.concat(F.lit("processed/"), col(date), F.lit("/"), stem, F.lit(".opus"))


def archive_key(batch_id: Column | str) -> Column:
    return F.concat(F.lit("archives/"), col(batch_id), F.lit(".tar"))


def batch_id(moment: Column | str, *seed: Column | str) -> Column:
    """YYYYMMDD-HHMMSS-{6 hex}; the hex part is a digest of the seed, so reruns agree."""
    digest = F.sha2(F.concat_ws("|", *[col(s) for s in seed]), 256)
    return F.concat_ws("-", batch_stamp(moment), F.substring(digest, 1, 6))
