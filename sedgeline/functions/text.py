"""Text expressions (Column to Column). White space is Unicode white space throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\s\p{Z}]"

# Accented Latin letters and their plain forms, position by position.
ACCENTED = "áàâäãåāéèêëēíìîïīóòôöõōúùûüūçñýÿšžćčńłśżź"
PLAIN = "aaaaaaaeeeeeiiiiioooooouuuuucnyyszccnlszz"
# Legal forms that end a body's name.
LEGAL_FORMS = ["clg", "ltd", "limited", "dac", "plc", "teo", "teoranta", "cpt", "uc"]


def stripped(c: Column) -> Column:
    """Without surrounding white space of any kind."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def squeezed(c: Column) -> Column:
    """Runs of white space as one blank, ends stripped."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def folded(c: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def clean_cell(c: Column, file_type: str = "") -> Column:
    """A cell's text; from PDFs also without glyph codes, line breaks and doubled blanks."""
    if file_type == "pdf":
        c = F.regexp_replace(c, r"\(cid:[0-9]+\)", "")
        c = F.regexp_replace(F.regexp_replace(c, r"[\r\n]", " "), " {2,}", " ")
    return stripped(c)


def header_key(c: Column) -> Column:
    """A header for matching: blanks and underscores as one blank, lower case, no closing punctuation."""
    return F.regexp_replace(F.lower(F.regexp_replace(stripped(c), r"[\s\p{Z}_]+", " ")), r"[\s\p{Z}.:/]+$", "")


def status_key(c: Column) -> Column:
    return header_key(F.replace(c, F.lit("-"), F.lit(" ")))


def bare_value(c: Column) -> Column:
    """Case and surrounding punctuation do not count."""
    return F.regexp_replace(F.replace(F.lower(squeezed(c)), F.lit("ß"), F.lit("ss")), r"^[.,;: ]+|[.,;: ]+$", "")


def body_name_key(c: Column) -> Column:
    """A body's name without bracketed parts and one closing legal form."""
    c = F.regexp_replace(c, f"{WS}*\\([^)]*\\){WS}*", " ")
    return F.lower(squeezed(F.regexp_replace(c, f"(?i){WS}*\\b({'|'.join(LEGAL_FORMS)})\\b\\.?{WS}*$", "")))


def match_key(c: Column) -> Column:
    """Letters and digits of a name without accents, brackets and articles; & is `and`."""
    c = F.replace(F.regexp_replace(folded(c), r"\([^)]*\)", " "), F.lit("&"), F.lit(" and "))
    c = F.regexp_replace(F.regexp_replace(c, "[^a-z0-9]+", " "), r"\bthe\b", " ")
    return F.trim(F.regexp_replace(c, " +", " "))


def local_authority_name(c: Column) -> Column:
    """`County Council - X` as `X County Council`; null in any other form."""
    form = r"(?i)^(city\s*(?:&|and)\s*county|county|city)\s+council\s*-\s*(.+)$"
    kind = F.regexp_replace(F.replace(F.lower(F.regexp_extract(F.trim(c), form, 1)), F.lit("&"), F.lit("and")), r"\s*and\s*", " and ")
    place = F.trim(F.regexp_extract(F.trim(c), form, 2))
    name = F.when(kind == "county", "County").when(kind == "city", "City").when(kind == "city and county", "City and County")
    return F.when(name.isNotNull() & (place != ""), F.concat_ws(" ", place, name, F.lit("Council")))


def name_slug(c: Column) -> Column:
    """Plain letters and digits joined by hyphens; & is `and`."""
    return F.regexp_replace(F.regexp_replace(F.replace(folded(c), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def text_slug(c: Column) -> Column:
    """Keeps accented letters; null or empty is `unknown`."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_\s-]", ""), r"\s+", "-")
    return F.when(F.coalesce(c, F.lit("")) == "", "unknown").otherwise(F.regexp_replace(s, "^-+|-+$", ""))


def resolved_slug(seed: Column, name: Column, key: Column) -> Column:
    """The seeded slug, else one from the name, else one from the key."""
    return F.coalesce(F.nullif(seed, F.lit("")), F.nullif(name_slug(name), F.lit("")), F.concat(F.lit("body-"), key.cast("string")))


def alnum_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def alias_key(c: Column) -> Column:
    """A heading's key: case, blanks, quotes and a leading table label do not count."""
    c = F.regexp_replace(F.lower(squeezed(c)), r"^table\s+a\s*:\s*", "")
    return F.regexp_replace(F.regexp_replace(c, "[\"“”]", ""), "^[ .:]+|[ .:]+$", "")


def joined_lines(lines: Column) -> Column:
    """Lines as running text; a word cut before a lower-case letter is healed."""
    join = lambda a, x: F.when(a == "", x).when(a.rlike(r"\p{L}-$") & x.rlike(r"^\p{Ll}"), F.concat(F.regexp_replace(a, "-$", ""), x)).otherwise(F.concat(a, F.lit(" "), x))
    return F.aggregate(F.filter(F.transform(lines, stripped), lambda x: x != ""), F.lit(""), join)


def list_kind(lines: Column) -> Column:
    """`bullet` or `ordered` if every line is such an item, else null."""
    full = F.filter(lines, lambda x: stripped(x) != "")
    every = lambda pattern: (F.size(full) > 0) & F.forall(full, lambda x: x.rlike(pattern))
    return F.when(every(r"^\s*[•‣*–-]\s+"), "bullet").when(every(r"^\s*(\(?[0-9]{1,3}[.)]|\(?[a-z][.)])\s+"), "ordered")


def without_markdown(c: Column) -> Column:
    """Plain text of markdown: headings, emphasis, code, links and rules."""
    for pattern, by in ((r"(?m)^#{1,6}[ \t]+", ""), (r"\*\*([^*]+)\*\*", "$1"), (r"`([^`]+)`", "$1"), (r"\[([^\]]+)\]\([^)]*\)", "$1"), (r"(?m)^[ \t]*[-*_]{3,}[ \t]*$", "")):
        c = F.regexp_replace(c, pattern, by)
    return c


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"


def emails(c: Column) -> Column:
    """Distinct addresses in a text, lower case, in order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(f"({EMAIL})"), F.lit(1))))


def picked_email(found: Column) -> Column:
    """struct(address, status): the only one, or the first that speaks of FOI, else none."""
    foi = F.filter(found, lambda x: x.contains("foi") | x.contains("freedom"))
    address = F.when(F.size(found) == 1, found[0]).when(F.size(foi) > 0, foi[0])
    status = F.when(F.size(found) == 0, "not_found").when(address.isNotNull(), "found").otherwise("multiple_found")
    return F.struct(address.alias("address"), status.alias("status"))


def tokens(c: Column) -> Column:
    """Distinct lower-case runs of plain letters or digits."""
    return F.array_remove(F.array_distinct(F.split(F.lower(c), "[^a-z0-9]+")), "")


def has_keyword(c: Column, keyword: str) -> Column:
    """The keyword as a whole word; case counts only for all-capital two-letter keywords."""
    literal = "".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in keyword)
    exact = keyword.isupper() and len(keyword) <= 2
    case = "" if exact else "(?i)"
    somewhere = F.contains(c if exact else F.lower(c), F.lit(keyword if exact else keyword.lower()))  # cheap, and false for most
    return somewhere & c.rlike(rf"{case}(^|[^\p{{L}}\p{{N}}_]){literal}($|[^\p{{L}}\p{{N}}_])")


def verification_tier(c: Column, strong: list[str], weak: list[str]) -> Column:
    """struct(tier, phrase): one strong phrase or two weak ones verify; empty is unverified; else rejected."""
    low = F.lower(c)
    held = lambda phrases: F.filter(F.array(*[F.lit(x) for x in phrases]), lambda x: F.contains(low, x))
    best = F.array_max(F.transform(held(strong), lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    tier = F.when(F.trim(F.coalesce(c, F.lit(""))) == "", "unverified").when(best.isNotNull() | (F.size(held(weak)) >= 2), "verified").otherwise("rejected")
    return F.struct(tier.alias("tier"), best.alias("phrase"))


def reference_parts(c: Column) -> Column:
    """struct(year, number, style) of a request reference in any of its printed styles, else nulls."""
    s = F.upper(squeezed(c))
    out = lambda style, y, n: F.struct(y.cast("int").alias("year"), n.cast("long").alias("number"), F.lit(style).alias("style"))
    ex = lambda p, k: F.nullif(F.regexp_extract(s, p, k), F.lit(""))
    forms = [
        ("prefixed", r"^FOI[/ -]([0-9]{4})[/ -]([0-9]+)$", 1, 2), ("of_year", r"^FOI ([0-9]+) OF ([0-9]{4})$", 2, 1), ("short_year", r"^F([0-9]{2})/([0-9]+)$", 1, 2),
        ("number_year", r"^([0-9]+)/([0-9]{4})$", 2, 1), ("year_number", r"^([0-9]{4})-([0-9]+)$", 1, 2), ("serial", r"^REQ ([0-9]+)$", 0, 1),
    ]
    got = F.lit(None)
    for style, p, y, n in reversed(forms):
        year = F.lit(None) if y == 0 else ex(p, y).cast("int") + (2000 if style == "short_year" else 0)
        got = F.when(s.rlike(p), out(style, year, ex(p, n))).otherwise(got)
    return got


# Flags printed behind an action's reference, in the order in which they are reported.
ACTION_FLAGS = ["non_reportable", "duplicate", "taskforce"]


def action_reference(c: Column) -> Column:
    """struct(number, printed, flags, year, error) of the reference an action plan prints for an action.

    A reference is an ordinal of one to three digits, or a code of two capitals, a two-digit year and a number, with a
    letter for a sub-action. Flags behind it are no part of it. Blanks beside a slash are a line wrap. What can't be
    read is never repaired: error is `UnresolvedActionNumber` or, for foreign signs or empty parts, `InvalidActionReference`.
    """
    printed = F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x07\s]+", " ")), r"\s*/\s*", "/")
    tail = F.regexp_extract(printed, r"((?:\s*(?:[*]|\(\s*TF\s*\)))*)\s*$", 1)
    core = F.trim(F.substring(printed, F.lit(1), F.length(printed) - F.length(F.regexp_extract(printed, r"((?:\s*(?:[*]|\(\s*TF\s*\)))*\s*)$", 1))))
    stars = F.transform(F.regexp_extract_all(tail, F.lit("([*]+)"), F.lit(1)), lambda x: F.length(x))
    has = {"non_reportable": F.exists(stars, lambda n: n % 2 == 1), "duplicate": F.exists(stars, lambda n: n >= 2), "taskforce": tail.contains("TF")}
    flags = F.array_compact(F.array(*[F.when(has[f], F.lit(f)) for f in ACTION_FLAGS]))
    ordinal, code = core.rlike("^[0-9]{1,3}$"), core.rlike("^[A-Z]{2}/[0-9]{2}/[0-9]+(/[A-Z]|[A-Z])?$")
    number = F.when(ordinal, core.try_cast("int").cast("string")).when(code, core)
    foreign = ~core.rlike("^[A-Za-z0-9]+(/[A-Za-z0-9]+)*$")
    error = F.when(number.isNotNull(), None).when(core.rlike("[A-Za-z0-9]") & foreign, "InvalidActionReference").otherwise("UnresolvedActionNumber")
    shown = F.when(ordinal & (F.size(flags) == 0), number).when(number.isNotNull(), printed)
    year = F.when(code, F.regexp_extract(core, "/([0-9]{2})/", 1).cast("int") + 2000)
    return F.struct(number.alias("number"), shown.alias("printed"), F.when(number.isNotNull(), flags).alias("flags"), year.alias("year"), error.alias("error"))


def parent_reference(number: Column) -> Column:
    """The reference of which a sub-action's is a part; null for any other."""
    return F.nullif(F.regexp_extract(number, "^([A-Z]{2}/[0-9]{2}/[0-9]+)(?:/[A-Z]|[A-Z])$", 1), F.lit(""))


def edition_year(slug: Column, pattern: str = r"^[a-z-]+-(20[0-9]{2})-annex-of-actions$") -> Column:
    """The year in the name of an edition; a name of another form raises, since a guess would sort actions wrongly."""
    return F.when(slug.rlike(pattern), F.regexp_extract(slug, pattern, 1).cast("int")).otherwise(F.raise_error(F.concat(F.lit("no edition year in "), F.coalesce(slug, F.lit("null")))).cast("int"))


def leading_ordinal(c: Column) -> Column:
    """struct(ordinal, text): the number that opens a text, before a dot or bracket, and the rest; without one the whole text."""
    form = r"(?s)^\s*([0-9]{1,4})\s*[.)]\s*[\x07\s]*(.*)$"
    return F.struct(F.when(c.rlike(form), F.regexp_extract(c, form, 1).cast("int")).alias("ordinal"), F.when(c.rlike(form), F.regexp_extract(c, form, 2)).otherwise(c).alias("text"))


def without_footnote(c: Column) -> Column:
    """A title without the number or sign of a footnote that sticks to its end."""
    return F.trim(F.regexp_replace(c, r"(?<=[\p{L})])\s*(\[[0-9]{1,2}\]|[0-9]{1,2}|[*†‡]+)\s*$", ""))


def cross_references(c: Column) -> Column:
    """array of struct(relationship, plan, number, evidence): the actions of other plans that brackets in a text name.

    Brackets that open with `Complements` complement, others reference; each names plans as `NAME Action(s) 1, 2 and 3`.
    """
    brackets = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\([^()]*\))"), F.lit(1))
    target = r"([A-Z][A-Za-z0-9]*(?: [A-Z0-9][A-Za-z0-9]*)*) Actions? ([0-9]+(?:(?:, | and |, and )[0-9]+)*)"

    def of(bracket: Column) -> Column:
        kind = F.when(bracket.rlike(r"(?i)^\(\s*complement"), "complements").otherwise("references")
        inner = F.regexp_replace(bracket, r"(?i)^\(\s*complement(s|ary)?( to)?\s+", "(")
        found = F.regexp_extract_all(inner, F.lit(f"({target})"), F.lit(1))
        one = lambda t: F.transform(F.regexp_extract_all(F.regexp_extract(t, target, 2), F.lit("([0-9]+)"), F.lit(1)), lambda n: F.struct(kind.alias("relationship"), F.regexp_extract(t, target, 1).alias("plan"), n.alias("number"), bracket.alias("evidence")))
        return F.flatten(F.transform(found, one))

    return F.flatten(F.transform(brackets, of))
