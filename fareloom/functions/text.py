"""Text expressions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareloom.functions.numbers import col

_MARK = "\u0001"


def title_words(c) -> Column:
    """Capitalise every run of letters and digits and lower the rest (``us-bangla`` -> ``Us-Bangla``).

    Spark's ``initcap`` starts words at blanks only. A marked blank behind every other separator
    lets it see all word starts; the marks are taken out again. All parts are code-generated.
    """
    marked = F.regexp_replace(F.lower(col(c)), r"([^\p{L}\p{N}])", "$1" + _MARK + " ")
    return F.replace(F.initcap(marked), F.lit(_MARK + " "), F.lit(""))


def clean_name(c) -> Column:
    return title_words(F.trim(col(c)))


def clean_code(c) -> Column:
    return F.upper(F.trim(col(c)))


def has_word(c, words) -> Column:
    """TRUE when the text holds any of the words; FALSE for NULL."""
    return F.coalesce(col(c).rlike("|".join(re.escape(w) for w in words)), F.lit(False))


def is_blank(c) -> Column:
    """NULL, empty or nothing but white space of any kind."""
    return col(c).isNull() | col(c).rlike(r"(?U)^\s*$")


def number_text(c) -> Column:
    """Amounts as text with two decimals."""
    return col(c).cast("decimal(38,2)").cast("string")


def time_text(c) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")
