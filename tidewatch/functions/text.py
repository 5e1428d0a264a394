"""Column expressions over numbers and categories written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\r\n\f\u000b\u00a0\ufeff"

# Texts that stand for a missing value.
NULL_TEXTS = ("", "nan", "null", "none", "na")

_INFINITIES = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def normalize_decimal(raw: Column) -> Column:
    """Rewrite a number in any decimal convention with a decimal point; null when empty."""
    text = F.btrim(raw.cast("string"), F.lit(_BLANKS))
    text = F.btrim(F.btrim(text, F.lit('"')), F.lit("'"))
    commas = F.length(text) - F.length(F.translate(text, ",", ""))
    has_dot = F.contains(text, F.lit("."))
    backwards = F.reverse(text)
    comma_is_last = F.instr(backwards, ",") < F.instr(backwards, ".")
    return (
        F.when(F.lower(text).isin(*NULL_TEXTS), F.lit(None).cast("string"))
        .when(commas == 0, text)
        .when(has_dot & comma_is_last, F.translate(text, ",.", "."))
        .when(has_dot | (commas > 1), F.translate(text, ",", ""))
        .otherwise(F.translate(text, ",", "."))
    )


def to_double(text: Column) -> Column:
    """Lenient cast: null for text that is no number.

    The cast would also take a `d` or `f` suffix and hexadecimal digits, so those letters are
    looked for first.
    """
    bare = F.btrim(text, F.lit(_BLANKS))
    plain = F.translate(bare, "dDfFxX", "") == bare
    return F.when(plain | F.lower(bare).isin(*_INFINITIES), bare.try_cast("double"))


def parse_decimal(raw: Column) -> Column:
    return to_double(normalize_decimal(raw))


def clean_category(raw: Column) -> Column:
    """Trimmed, lower-case level; null for a missing one."""
    level = F.lower(F.btrim(raw, F.lit(_BLANKS + '"')))
    return F.when(~level.isin(*NULL_TEXTS, "n/a"), level)


def decimal_convention(any_comma: Column, any_dot: Column) -> Column:
    return (
        F.when(any_comma & any_dot, "mixed")
        .when(any_comma, "comma")
        .when(any_dot, "dot")
        .otherwise("none")
    )
