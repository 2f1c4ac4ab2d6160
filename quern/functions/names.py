"""Company names: brands, slugs, fuzzy ratio, social urls, homepages."""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from . import text as T, urls as U

#: Fixed social hosts and canonical forms.
SOCIAL_HOSTS = {"linkedin.com": "linkedin", "facebook.com": "facebook", "instagram.com": "instagram", "x.com": "x", "twitter.com": "x", "youtube.com": "youtube", "youtu.be": "youtube", "tiktok.com": "tiktok"}
#: Fixed first path steps that are no profile.
NO_PROFILE = {
    "facebook": ("sharer", "sharer.php", "share.php", "dialog", "policy.php", "privacy", "events", "groups", "plugins", "profile.php"),
    "instagram": ("p", "reel", "reels", "stories", "explore"), "x": ("intent", "share", "home", "search", "i"),
}


def _last(words: Column) -> Column:
    """Words without their trailing legal suffixes."""
    text = F.array_join(words, " ")
    return F.filter(F.split(F.regexp_replace(text, rf"( ({'|'.join(T.LEGAL_WORDS)}))+$", ""), " "), lambda w: w != "")


def brand_tokens(name: Column, site: Column) -> Column:
    """Name words of four letters or more, all words joined, the site's label."""
    words = _last(T.tokens(name, keep_legal=True, min_length=1))
    label = T.folded(F.element_at(F.split(U.registrable(U.host(site)), r"\."), 1))
    every = F.concat(words, F.array(F.array_join(words, ""), label))
    return F.array_sort(F.array_distinct(F.filter(every, lambda w: F.length(w) >= 4)))


def named(name: Column, text: Column) -> Column:
    """The whole distinctive name in a row, or joined to one word of six letters or more."""
    words, seen = _last(T.tokens(name, keep_legal=True, min_length=1)), T.tokens(text, keep_legal=True, min_length=1)
    short = (F.size(words) == 1) & (F.length(F.array_join(words, "")) < 5)
    joined = F.array_join(words, "")
    return ~short & (T.contains_sequence(seen, words) | ((F.length(joined) >= 6) & F.array_contains(seen, joined)))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio (no built-in function has this measure)."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


@F.pandas_udf(StringType())
def idna(label: pd.Series) -> pd.Series:
    def one(x):
        try:
            return x.encode("idna").decode() if x else None
        except UnicodeError:
            return None

    return label.map(one)


def domain_slugs(name: Column) -> Column:
    """Candidate domains: joined and hyphenated words, with and without -as."""
    words = _last(T.tokens(name, keep_legal=True, min_length=1))
    joined, dashed = F.array_join(words, ""), F.array_join(words, "-")
    every = F.array(joined, dashed, F.concat(joined, F.lit("-as")), F.concat(joined, F.lit("as")))
    return F.when(F.size(words) > 0, F.array_distinct(F.transform(every, lambda s: F.concat(s, F.lit(".no"))))).otherwise(F.array().cast("array<string>"))


@F.pandas_udf(ArrayType(StringType()))
def domain_labels(name: pd.Series) -> pd.Series:
    """Candidate domain labels (IDNA): folded and unfolded words, joined and hyphenated, then the first with as and -as."""
    def one(x):
        bare = " ".join(re.sub(r"\b(?:AS|ASA|ANS|DA|ENK|NUF|SA)\b", " ", x or "", flags=re.I).split())
        folded = bare.translate(str.maketrans({"æ": "ae", "ø": "o", "å": "a", "Æ": "AE", "Ø": "O", "Å": "A"}))
        out: list[str] = []
        for t in (unicodedata.normalize("NFKD", folded).encode("ascii", "ignore").decode().casefold(), bare.casefold()):
            words = re.findall(r"[^\W_]+", t)
            if any(len(w) > 1 for w in words):
                pair = ["".join(words), "-".join(words)]
                for label in reversed(pair) if re.search(r"\w-\w", t) else pair:
                    try:
                        code = label.encode("idna").decode()
                    except UnicodeError:
                        continue
                    if 3 <= len(label) and len(code) <= 63 and code not in out:
                        out.append(code)
        return out + [out[0] + s for s in ("as", "-as") if len(out[0] + s) <= 63 and out[0] + s not in out] if out else out

    return name.map(one)


def homepage(value: Column) -> Column:
    """scheme://authority/path of an HTTP(S) address; a missing scheme is https."""
    v = F.trim(value)
    v = F.when(v.rlike("(?i)^https?://"), v).otherwise(F.concat(F.lit("https://"), v))
    parts = F.regexp_extract(v, r"(?i)^(https?)://([^/?#]+)([^?#]*)", 0)
    out = F.concat(F.lower(F.regexp_extract(v, r"^([A-Za-z]+)://", 1)), F.lit("://"), F.regexp_extract(v, r"://([^/?#]+)", 1), F.when(U.path(v) == "", "/").otherwise(U.path(v)))
    return F.when((F.trim(value) != "") & (parts != "") & (U.host(v) != ""), out)


def social_profile(url: Column) -> Column:
    """Struct(platform, url) of a profile address, null for anything else."""
    h = U.host(url)
    platform = F.coalesce(*(F.when((h == d) | F.endswith(h, F.lit("." + d)), F.lit(p)) for d, p in SOCIAL_HOSTS.items()))
    steps = F.filter(F.split(U.path(url), "/"), lambda s: s != "")
    first = F.lower(F.try_element_at(steps, F.lit(1)))
    at = F.startswith(first, F.lit("@"))
    bad = F.size(steps) == 0
    for p, names in NO_PROFILE.items():
        bad = bad | ((platform == p) & first.isin(*names))
    bad = bad | ((platform == "linkedin") & ((first != "company") | (F.size(steps) < 2))) | ((platform == "youtube") & ~first.isin("channel", "user", "c") & ~at) | (h == "youtu.be")
    bad = bad | ((platform == "tiktok") & ~at) | ((platform == "x") & (F.size(steps) != 1))
    keep = F.when(platform == "linkedin", F.slice(steps, 1, 2)).when((platform == "youtube") & at, F.slice(steps, 1, 1)).when(platform == "youtube", F.slice(steps, 1, 2)).otherwise(steps)
    out = F.concat(F.lit("https://"), platform, F.lit(".com/"), F.array_join(keep, "/"))
    return F.when(platform.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.struct(platform.alias("platform"), out.alias("url")))


def map_score(name: Column, address: Column, phone: Column, site: Column, postcode: Column, reviews: Column) -> Column:
    """Weighted map candidate score; many reviews add up to one point."""
    bit = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    weight = F.least(F.lit(1.0), F.log10(F.greatest(F.lit(1), F.coalesce(reviews, F.lit(0)))) / 5)
    return F.round(name * 4 + bit(address) * 3 + bit(phone) * 2 + bit(site) * 3 + bit(postcode) * 2 + weight, 4)


def map_accepted(name: Column, address: Column, phone: Column, site: Column, fuzzy: Column) -> Column:
    channels = sum((F.coalesce(c, F.lit(False)).cast("int") for c in (address, phone, site)), F.lit(0))
    return ((name >= 0.99) & (channels >= 1)) | ((name >= 0.66) & (channels >= 2)) | (site & (fuzzy >= 0.85))
