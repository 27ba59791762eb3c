"""Amounts, quantities and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedgeline.functions.text import clean_cell


def amount(c: Column) -> Column:
    """struct(value, error, repaired) of a printed whole-euro amount.

    Currency sign, thousands groups of three and blanks are form; cents must be 00. Nothing is
    taken out of a cell that also holds letters. A null cell is empty.
    """
    raw = F.coalesce(clean_cell(c, "pdf"), F.lit(""))
    after = F.trim(F.element_at(F.split(raw, "€"), -1))
    compact = F.regexp_replace(after, r"\s", "")
    whole = F.regexp_replace(compact, r"\..*$", "")
    cents = F.when(compact.contains("."), F.regexp_extract(compact, r"^[^.]*\.(.*)$", 1))
    error = (
        F.when(raw == "", "empty")
        .when(raw.rlike("[A-Za-z]"), "letters")
        .when(compact.isin("", "-"), "no_digits")
        .when(cents.isNotNull() & ~cents.rlike("^[0-9]{2}$"), "not_numeric")
        .when(cents.isNotNull() & (cents != "00"), "sub_euro_amount")
        .when(whole.startswith(","), "ambiguous_grouping")
        .when(~whole.rlike("^[0-9]+(,[0-9]+)*$"), "not_numeric")
        .when(whole.contains(",") & ~whole.rlike("^[0-9]{1,3}(,[0-9]{3})+$"), "ambiguous_grouping")
    )
    value = F.when(error.isNull(), F.replace(whole, F.lit(","), F.lit("")).try_cast("bigint"))
    return F.struct(value.alias("value"), error.alias("error"), F.coalesce(error.isNull() & after.rlike(r"\s"), F.lit(False)).alias("repaired"))


def quantity(c: Column) -> Column:
    """A decimal with two places, null where it is none."""
    return F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("decimal(18,2)")


def activity_code(c: Column) -> Column:
    """struct(section, division, group, class) of a code of one letter and four digits, else null."""
    code = F.upper(F.trim(c))
    return F.when(code.rlike("^[A-U][0-9]{4}$"), F.struct(F.substring(code, 1, 1).alias("section"), F.substring(code, 2, 2).alias("division"), F.substring(code, 2, 3).alias("group"), F.substring(code, 2, 4).alias("class")))
