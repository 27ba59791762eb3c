"""URL expressions: hosts, sites, safety, guesses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedgeline.functions.text import folded

# Second-level names under country codes.
SECOND_LEVEL = ["co", "ac", "org", "net", "com"]
#: Hosts on which many bodies have their own path.
SHARED_HOSTS = ["gov.ie"]


def host(c: Column) -> Column:
    """Lower-case host name without `www.`, port and user; empty where there is none."""
    h = F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(F.regexp_replace(h, r"^\.+|\.+$", ""), r"^www\.", "")


def registrable_domain(c: Column) -> Column:
    """The last two labels of the host, three under a country's second level; empty for less."""
    labels = F.filter(F.split(host(c), r"\."), lambda x: x != "")
    n = F.size(labels)
    three = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.try_element_at(labels, F.lit(-2)).isin(SECOND_LEVEL)
    return F.when(n < 2, "").otherwise(F.array_join(F.slice(labels, F.when(three, -3).otherwise(-2), F.when(three, 3).otherwise(2)), "."))


def site_key(c: Column) -> Column:
    """What counts as one site: the domain, or on shared hosts the domain and three path segments."""
    path = F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1))
    segments = F.slice(F.filter(F.split(path, "/"), lambda x: x != ""), 1, 3)
    d = registrable_domain(c)
    return F.when(d.isin(SHARED_HOSTS), F.concat_ws("/", d, F.array_join(segments, "/"))).otherwise(d)


def root_url(c: Column) -> Column:
    return F.concat(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.lit("/"))


def is_safe_url(c: Column) -> Column:
    """http(s) to a public host: no user part, no local name, no private, loopback or link-local address."""
    h = host(c)
    private = h.rlike(r"^(127\.|10\.|192\.168\.|169\.254\.|172\.(1[6-9]|2[0-9]|3[01])\.|0\.)") | h.isin("localhost", "0", "[") | h.endswith(".local") | h.endswith(".internal") | h.endswith(".localhost")
    return F.coalesce(c.rlike(r"(?i)^https?://[^/?#@]+([/?#]|$)") & ~private & h.contains("."), F.lit(False))


def loggable_url(c: Column) -> Column:
    """Host only, at most 50 characters."""
    return F.substring(host(c), 1, 50)


def extension(c: Column) -> Column:
    """The file name's extension in lower case, empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), r"\.([A-Za-z0-9]{1,5})(?:[?#].*)?$", 1))


def guessed_domains(name: Column, most: int = 6) -> Column:
    """Domain guesses of a name: its words joined, hyphened, and their initials, at most `most`."""
    words = F.filter(F.split(folded(name), "[^a-z0-9]+"), lambda x: (x != "") & ~x.isin("the", "of", "and", "for", "an", "na"))
    initials = F.array_join(F.transform(words, lambda x: F.substring(x, 1, 1)), "")
    stems = F.filter(F.array(initials, F.array_join(words, ""), F.array_join(words, "-")), lambda x: F.length(x) >= 3)
    return F.slice(F.array_distinct(F.flatten(F.transform(stems, lambda s: F.array(F.concat(s, F.lit(".ie")), F.concat(s, F.lit(".com")))))), 1, most)
