"""Date expressions: deadlines with precision, and free-entered date cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sedgeline.functions.text import squeezed, stripped

# Month names by number.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
# What date columns hold instead of dates (headings and states, English and Irish).
NO_DATES = ["n/a", "na", "null", "none", "-", "---", "date received", "date", "received", "decision date", "decision", "date issued", "date of request", "pending", "withdrawn", "granted", "refused", "transferred", "dáta", "dáta fála", "cinneadh"]


def month_number(name: Column) -> Column:
    """1 to 12 for a month's full name, its first three letters, `sept`, or its number; else null."""
    named = {w: k for k, m in enumerate(MONTHS, 1) for w in (m, m[:3])} | {"sept": 9}
    table = F.create_map(*[F.lit(x) for pair in sorted(named.items()) for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(name)), name.try_cast("int"))


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once: generated code would otherwise repeat it at each use."""
    return F.transform(F.array(value), then)[0]


def _day(y: Column, m: Column, d: Column) -> Column:
    """The date of year, month and day, null where the calendar has none."""
    return F.format_string("%04d-%02d-%02d", y, m, d).try_cast("date")


#: (form, the same as kind|year|month or quarter|day or second year|second quarter)
DEADLINES = [
    (r"(?i)^q([1-4]) ([0-9]{4}) ?[–—-] ?q([1-4]) ([0-9]{4})$", "quarters|$2|$1|$4|$3"), (r"(?i)^q([1-4]) ([0-9]{4})$", "quarter|$2|$1"), (r"(?i)^([0-9]{4}) q([1-4])$", "quarter|$1|$2"),
    (r"^([0-9]{4})-([0-9]{2})-([0-9]{2})$", "day|$1|$2|$3"), (r"^([0-9]{1,2}) ([A-Za-z]+) ([0-9]{4})$", "day|$3|$2|$1"), (r"^([A-Za-z]+) ([0-9]{4})$", "month|$2|$1"),
    (r"^([0-9]{4}) ?[–—-] ?([0-9]{4})$", "years|$1|1|$2|4"), (r"^([0-9]{4})$", "year|$1"), (r"(?i)^(annual|ongoing)\b[^0-9]*$", "$1"),
]


def deadline(c: Column) -> Column:
    """struct(precision, year, quarter, month, day, start, end) of a deadline, null if it is none.

    Days (ISO, `1 May 2024`), months, quarters (either order), years, ranges of quarters or
    years, and the open ends `annual` and `ongoing` (only without digits). Day/month/year in
    figures is refused: its order is unknown.
    """
    def read(t: Column) -> Column:
        return F.split(F.lower(F.coalesce(*[F.when(t.rlike(p), F.regexp_replace(t, p, to)) for p, to in DEADLINES])), r"\|")

    def fields(s: Column) -> Column:
        part = lambda k: F.try_element_at(s, F.lit(k))
        return F.struct(part(1).alias("k"), part(2).try_cast("int").alias("y"), month_number(part(3)).alias("x"), part(4).try_cast("int").alias("z"), part(5).try_cast("int").alias("w"))

    def dated(f: Column) -> Column:
        k, y, x, z, w = (f[n] for n in "kyxzw")
        first = F.when(k.isin("quarter", "quarters"), F.make_date(y, x * 3 - 2, F.lit(1))).when(k == "day", _day(y, x, z)).when(k == "month", _day(y, x, F.lit(1))).when(k.isin("year", "years"), F.make_date(y, F.lit(1), F.lit(1)))
        last = F.when(k == "quarter", F.last_day(F.make_date(y, x * 3, F.lit(1)))).when(k.isin("quarters", "years"), F.last_day(F.make_date(z, w * 3, F.lit(1)))).when(k == "day", first).when(k == "month", F.last_day(first)).when(k == "year", F.make_date(y, F.lit(12), F.lit(31)))
        return F.struct(f.alias("f"), first.alias("start"), last.alias("end"))

    def made(g: Column) -> Column:
        f = g["f"]
        only = lambda n, *kinds: F.when(f["k"].isin(*kinds), f[n])
        return F.when(g["start"].isNotNull() | f["k"].isin("annual", "ongoing"), F.struct(
            F.when(f["k"].isin("quarters", "years"), "range").otherwise(f["k"]).alias("precision"), only("y", "quarter", "day", "month", "year").alias("year"), only("x", "quarter").alias("quarter"),
            only("x", "day", "month").alias("month"), only("z", "day").alias("day"), g["start"].alias("start"), g["end"].alias("end"),
        ))

    return bound(bound(bound(bound(squeezed(c), read), fields), dated), made)


_NAME = r"([A-Za-z]{3,9})\.?"
#: (form, the same as year|month|day), in the order in which they are tried; slashes may be month first.
FORMS = [
    (r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", "$1|$2|$3"),
    (rf"([0-9]{{1,2}})-{_NAME}-([0-9]{{4}}|[0-9]{{2}})", "$3|$2|$1"),
    (r"([0-9]{1,2})\.([0-9]{1,2})\.'?([0-9]{4}|[0-9]{2})", "$3|$2|$1"),
    (r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{4}|[0-9]{2})", "$3|$2|$1"),
    (r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2})", "$3|$2|$1|swap"),
    (rf"{_NAME} ([0-9]{{1,2}}),? ([0-9]{{4}})", "$3|$1|$2"),
    (rf"([0-9]{{1,2}})(?:st|nd|rd|th)? {_NAME},? ([0-9]{{4}})", "$3|$2|$1"),
]


def date_cell(c: Column) -> Column:
    """The ISO date of a free-entered date cell, by the forms alone; null if it has none.

    Of a longer cell the first date in it counts, at its start before elsewhere. Day comes before
    month, unless the month is impossible and the order is by slashes. Two-digit years up to 29 are of this
    century. Years outside 1900 to 2100, cells over 60 characters and cells without digits give null.
    """
    def read(t: Column) -> Column:
        tries = [(f"(?is){before}{p}(?![0-9A-Za-z]).*$", to) for before in ("^", r"^.*?(?<![0-9A-Za-z])") for p, to in FORMS]
        usable = (F.length(t) <= 60) & t.rlike("[0-9]") & ~F.lower(t).isin(NO_DATES)
        return F.split(F.when(usable, F.coalesce(*[F.when(t.rlike(p), F.regexp_replace(t, p, to)) for p, to in tries])), r"\|")

    def numbers(s: Column) -> Column:
        y = s[0].try_cast("int")
        year = F.when(F.length(s[0]) == 2, y + F.when(y <= 29, 2000).otherwise(1900)).otherwise(y)
        month = F.coalesce(s[1].try_cast("int"), month_number(F.substring(s[1], 1, 3)))
        return F.struct(year.alias("y"), month.alias("m"), s[2].try_cast("int").alias("d"), (F.size(s) == 4).alias("slashes"))

    def dated(n: Column) -> Column:
        swap = n["slashes"] & (n["m"] > 12) & (n["d"] <= 12)
        return F.when(n["y"].between(1900, 2100), F.date_format(_day(n["y"], F.when(swap, n["d"]).otherwise(n["m"]), F.when(swap, n["m"]).otherwise(n["d"])), "yyyy-MM-dd"))

    t = F.regexp_replace(squeezed(F.regexp_replace(stripped(c), r"^\*+", "")), r"\^\{?(st|nd|rd|th)\}?", "$1")
    return bound(bound(bound(t, read), numbers), dated)


@F.pandas_udf(StringType())
def _parsed_anyhow(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    from dateutil.parser import ParserError, parse

    def one(v):
        try:
            d = parse(v, dayfirst=True)
            return d.strftime("%Y-%m-%d") if 1900 <= d.year <= 2100 else None
        except (ParserError, ValueError, OverflowError, TypeError):
            return None

    for s in values:
        known = {v: one(v) for v in s.dropna().unique()}
        yield pd.Series([known.get(v) for v in s], dtype=object)


def date_cell_or_guess(c: Column) -> Column:
    """As date_cell(); what no form fits is left to a lenient parser (day first), in Arrow batches."""
    form = date_cell(c)
    return F.coalesce(form, _parsed_anyhow(F.when(form.isNull() & (F.length(c) <= 60) & c.rlike("[0-9]"), stripped(c))))


def date_issue(c: Column) -> Column:
    """Why a non-blank cell is no date: UnparseableDate with digits, TextInDateColumn without."""
    return F.when((F.trim(F.coalesce(c, F.lit(""))) != "") & date_cell(c).isNull(), F.when(c.rlike("[0-9]"), "UnparseableDate").otherwise("TextInDateColumn"))


def latest_deadline(text: Column) -> Column:
    """The latest `Qn yyyy` or `yyyy` in a text, as struct(year, quarter), years beside a dash left out."""
    found = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"((?:q[1-4] )?(?<![0-9–—-])[0-9]{4}(?![0-9–—-]))"), F.lit(1)), lambda x: F.struct(F.right(x, F.lit(4)).cast("int").alias("year"), F.coalesce(F.nullif(F.regexp_extract(x, "q([1-4])", 1), F.lit("")).cast("int"), F.lit(4)).alias("quarter")))
    return F.array_max(found)




def link_date(c: Column) -> Column:
    """The date in a link's text or address: ISO, `5 May 2024`, or a run of eight figures (day first); null if none."""
    def tried(t: Column) -> Column:
        tries = [(r"(?is)^.*?(?<![0-9])([0-9]{4})[-_/]([0-9]{2})[-_/]([0-9]{2})(?![0-9]).*$", "$1|$2|$3"), (rf"(?is)^.*?(?<![0-9])([0-9]{{1,2}})(?:st|nd|rd|th)?[ _%20.-]+{_NAME}[ _%20,.-]+([0-9]{{4}})(?![0-9]).*$", "$3|$2|$1"), (r"(?s)^.*?(?<![0-9])([0-3][0-9])([01][0-9])((?:19|20)[0-9]{2})(?![0-9]).*$", "$3|$2|$1")]
        return F.split(F.coalesce(*[F.when(t.rlike(p), F.regexp_replace(t, p, to)) for p, to in tries]), r"\|")

    return bound(bound(c, tried), lambda s: _day(s[0].try_cast("int"), month_number(s[1]), s[2].try_cast("int")))


def resolved_date(upstream: Column, stated: Column, text: Column, lines: int = 15) -> Column:
    """A meeting's date: the upstream one, else the stated one, else day and month from the top lines with a year that stands there too."""
    top = F.array_join(F.slice(F.split(text, r"\r?\n"), 1, lines), " ")
    day = F.regexp_extract(top, rf"(?i)(?<![0-9])([0-9]{{1,2}})(?:st|nd|rd|th)?\s+(?:of\s+)?({'|'.join(MONTHS)})\b", 1).try_cast("int")
    month = F.regexp_extract(top, rf"(?i)(?<![0-9])[0-9]{{1,2}}(?:st|nd|rd|th)?\s+(?:of\s+)?({'|'.join(MONTHS)})\b", 1)
    year = F.regexp_extract(top, r"\b((?:19|20)[0-9]{2})\b", 1).try_cast("int")
    return F.coalesce(upstream, stated, _day(year, month_number(month), day))


def year_quarter(c: Column) -> Column:
    """struct(year, quarter) of a strict `Qn yyyy`, else null."""
    return F.when(c.rlike("^Q[1-4] [0-9]{4}$"), F.struct(F.right(c, F.lit(4)).cast("int").alias("year"), F.substring(c, 2, 1).cast("int").alias("quarter")))
