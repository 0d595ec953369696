"""Column functions: text cleaning, rounding, dates, scaling. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DIGITS = "^[0-9]+$"
DATE = "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"


def only(c: Column, pattern: str) -> Column:
    """The text if it matches as a whole, else null.

    Names its input once: a test and a conversion side by side would compute the input twice, as
    filters and branches share no common subexpressions. Null also spares the cast a failed parse.
    """
    return F.get(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), F.lit(0))


def let(c: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of ``c`` with ``c`` computed once, however often ``fn`` names it.

    Keeps the generated code of a pushed-down filter small enough to be compiled.
    """
    return F.get(F.transform(F.array(c), fn), F.lit(0))


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only U+0020."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def number(c: Column) -> Column:
    """Plain decimal text to double; anything else, 'nan' and Java suffixes included, is null."""
    return only(c, NUMBER).try_cast("double")


def no_nan(c: Column) -> Column:
    """NaN to null, the only missing value the operators know."""
    return F.when(~F.isnan(c), c)


def clean_price_string(c: Column) -> Column:
    """Scraped price text to a whole number: drop ``Rp``, ``.`` and ``,``; only digits may remain."""
    bare = strip(F.regexp_replace(c, "Rp|[.,]", ""))
    return only(bare, DIGITS).try_cast("bigint")


def clean_price(c: Column, kind: T.DataType | None = None) -> Column:
    """Training price to double. Numbers pass; text loses its separators and must then be a number."""
    if isinstance(kind, T.NumericType):
        return no_nan(c.cast("double"))
    bare = F.translate(strip(c), ",.", "")
    return number(bare)


def clean_shop_price(c: Column) -> Column:
    """Shop price to a whole number; null counts as 0, unreadable text becomes null (a reject).

    Text with exactly one character after its last point is in thousands (``45.5`` is 45,500).
    """
    def read(bare: Column) -> Column:
        in_thousands = bare.rlike(r"(?s)\.[^.]$")
        value = F.when(in_thousands, number(bare) * 1000.0).otherwise(number(F.translate(bare, ".,", "")))
        return value.try_cast("bigint")

    text = F.coalesce(c.cast("string"), F.lit("0"))
    return let(strip(F.replace(text, F.lit("Rp"), F.lit(""))), read)


def clean_rating(c: Column) -> Column:
    """Rating text with a decimal comma or point to double; unreadable or null is 0."""
    return F.coalesce(number(strip(F.translate(c.cast("string"), ",", "."))), F.lit(0.0))


def normalize_name(c: Column) -> Column:
    """Upper case letters and digits only, the form names are matched in."""
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")


def header_date(c: Column) -> Column:
    """Day/month/year header text to a date; blanks are ignored, impossible dates are null."""
    bare = F.replace(c, F.lit(" "), F.lit(""))
    return F.try_to_date(only(bare, DATE), "d/M/yyyy")


def rupiah(c: Column) -> Column:
    """``Rp 12.345``"""
    return F.concat(F.lit("Rp "), F.translate(F.format_number(c, 0), ",", "."))


def round_to(c: Column, step: int = 100) -> Column:
    """Nearest multiple of ``step``, halves to the even multiple."""
    return F.bround(c / F.lit(float(step)), 0) * F.lit(float(step))


def round_int(c: Column) -> Column:
    """Nearest whole number, halves to even."""
    return F.bround(c, 0).cast("bigint")


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def file_stem(path: Column) -> Column:
    """File name without folder and extension."""
    return F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"\.[^.]*$", "")


def stem_keys(stem: Column, names: tuple[str, ...]) -> list[Column]:
    """The key columns in a file stem, cut at the first underscore(s); all null if one is missing."""
    parts = F.split(stem, "_", len(names))
    whole = F.size(parts) == len(names)
    return [F.when(whole, F.get(parts, F.lit(i))).alias(name) for i, name in enumerate(names)]


def file_key(c: Column) -> Column:
    """A key as it is written in paths."""
    return F.translate(c, " ", "_")


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def to_date_or_null(c: Column, formats: Sequence[str] = ()) -> Column:
    """ISO date text, with or without a time part, or text of one of ``formats``, to a date; else null."""
    text = strip(c)
    return F.coalesce(text.try_cast("date"), *(F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats))


def scale(c: Column, low: Column, high: Column) -> Column:
    """Min-max scaling without clipping; constant data scales to 0."""
    span = high - low
    return (c - low) / F.when(span == 0, F.lit(1.0)).otherwise(span)


def unscale(c: Column, low: Column, high: Column) -> Column:
    span = high - low
    return c * F.when(span == 0, F.lit(1.0)).otherwise(span) + low


def clip01(c: Column) -> Column:
    """Limit to [0, 1]; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def one_hot(c: Column, levels) -> Column:
    """A 0/1 array over the sorted levels."""
    return F.array(*[F.when(c == level, 1.0).otherwise(0.0) for level in sorted(levels)])


def implausible(c: Column, high: float) -> Column:
    """A filled price that must not be used: missing, negative or above the highest plausible one."""
    return c.isNull() | F.isnan(c) | (c < 0) | (c > F.lit(float(high)))


def same_text(c: Column, value: str, case_insensitive: bool = False) -> Column:
    """Equality; optionally without regard to case and accents."""
    if case_insensitive:
        return F.collate(c, "UNICODE_CI_AI") == F.lit(value)
    return c == F.lit(value)
