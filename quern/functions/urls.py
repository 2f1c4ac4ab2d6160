"""URL parts, redaction and classification as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed second-level labels under which a registrable domain has three labels.
SECOND_LEVEL = ("co", "com", "org", "gov", "ac")
#: Fixed query parameters whose values are secret.
SECRET_PARAMETERS = ("key", "api_key", "apikey", "secret", "token", "access_token", "auth")


def host(url: Column) -> Column:
    """Lower-case host without port, user or www.; a missing scheme is allowed."""
    h = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.regexp_replace(h, r"^www\.", "")


def registrable(h: Column) -> Column:
    labels = F.split(h, r"\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, -k, k), ".")
    return F.when(n <= 2, h).when(F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LEVEL), last(3)).otherwise(last(2))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_parts(url: Column) -> Column:
    """Every host reading that callers use, as one struct."""
    h = host(url)
    labels = F.split(h, r"\.")
    return F.struct(h.alias("host"), registrable(h).alias("registrable"), F.when(F.size(labels) < 2, h).otherwise(F.array_join(F.slice(labels, -2, 2), ".")).alias("last_two"), path(url).alias("path"))


def is_hub(url: Column) -> Column:
    """A front or listing page: no path, or one short step without digits."""
    steps = F.filter(F.split(path(url), "/"), lambda s: s != "")
    return (F.size(steps) == 0) | ((F.size(steps) == 1) & ~F.element_at(F.concat(steps, F.array(F.lit(""))), 1).rlike("[0-9]"))


def redacted(url: Column) -> Column:
    return F.regexp_replace(url, rf"(?i)([?&](?:{'|'.join(SECRET_PARAMETERS)})=)[^&#]*", "$1REDACTED")


def host_suffixes(h: Column) -> Column:
    """The host and all its parent domains, for equi-joins on domain suffixes."""
    labels = F.split(h, r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
