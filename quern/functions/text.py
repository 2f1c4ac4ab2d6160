"""Tokenisers, name matching and small text features as Column expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType

#: Fixed legal words that name tokens leave out.
LEGAL_WORDS = ("as", "asa", "sa", "ba", "da", "ans", "enk", "nuf", "sti")
#: Accent folding: ø and å by rule of the names, all other lower-case Latin letters to the
#: letter they decompose to (æ becomes ae before).
_LATIN = [chr(c) for r in (range(0xE0, 0x250), range(0x1E00, 0x1F00)) for c in r if chr(c) == chr(c).lower() and chr(c) not in "øå"]
_BASE = {c: unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode() for c in _LATIN}
ACCENTS = "øå" + "".join(c for c, b in _BASE.items() if len(b) == 1)
PLAIN = "oa" + "".join(b for b in _BASE.values() if len(b) == 1)
#: Fixed headline phrases.
CLICKBAIT = (
    r"\bdu vil ikke tro\b", r"\bsjokk(?:erend|ert|)\b", r"\bavslørt\b", r"\bhemmelig(?:het|)\b", r"\bderfor raser\b", r"\bher er trikset\b", r"\bkatastrofe\b", r"\bpanikk\b",
    r"\byou won't believe\b", r"\bshocking\b", r"\bsecret revealed\b", r"\bthis one trick\b", r"\bclick here\b", r"\bmust read\b", r"\bblow your mind\b",
)


def folded(col: Column) -> Column:
    return F.translate(F.replace(F.lower(col), F.lit("æ"), F.lit("ae")), ACCENTS, PLAIN)


def tokens(col: Column, *, keep_legal: bool = False, min_length: int = 2, drop: tuple[str, ...] = LEGAL_WORDS) -> Column:
    """Folded [a-z0-9]+ tokens of min_length or more, without the words of drop; null gives an empty array."""
    found = F.regexp_extract_all(folded(F.coalesce(col, F.lit(""))), F.lit(f"([a-z0-9]{{{min_length},}})"), F.lit(1))
    return found if keep_legal else F.filter(found, lambda t: ~t.isin(*drop))


def spaced(toks: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(toks, " "), F.lit(" "))


def contains_sequence(text_tokens: Column, name_tokens: Column) -> Column:
    """True if the name's tokens stand in a row in the text."""
    return (F.size(name_tokens) > 0) & F.contains(spaced(text_tokens), spaced(name_tokens))


def overlap_ratio(a: Column, b: Column) -> Column:
    """Share of a's distinct tokens that b has; 0 for an empty a."""
    n = F.size(F.array_distinct(a))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / n)


def org_numbers(col: Column) -> Column:
    """Distinct 9-digit numbers, also written 3-3-3 with blanks, dots or dashes, and after NO, MVA or Org.nr."""
    t = F.coalesce(col, F.lit(""))
    plain = F.regexp_extract_all(t, F.lit("(?<![0-9])([0-9]{3}[\\s.\u00a0-]*[0-9]{3}[\\s.\u00a0-]*[0-9]{3})(?![0-9])"), F.lit(1))
    marked = F.regexp_extract_all(t, F.lit("(?i)(?:NO|MVA|ORG\\.?NR\\.?|ORG\\.?)\\s*:?\\s*([0-9]{3}[\\s.\u00a0-]*[0-9]{3}[\\s.\u00a0-]*[0-9]{3})\\b"), F.lit(1))
    return F.array_distinct(F.transform(F.concat(plain, marked), lambda x: F.regexp_replace(x, "[^0-9]", "")))


def plain_tokens(col: Column) -> Column:
    """Tokens with æ, ø and å folded only: three letters or more, or numbers, without legal words."""
    t = F.translate(F.replace(F.lower(F.coalesce(col, F.lit(""))), F.lit("æ"), F.lit("ae")), "øå", "oa")
    found = F.regexp_extract_all(t, F.lit("([a-z0-9]+)"), F.lit(1))
    return F.filter(found, lambda x: ~x.isin(*LEGAL_WORDS) & ((F.length(x) >= 3) | x.rlike("^[0-9]+$")))


#: Fixed pattern of a legal entity's name.
LEGAL_ENTITY = "(?i)(?:[A-Za-zÆØÅæøå][A-Za-zÆØÅæøå&.'’\\- ]{1,80})\\s+(?:AS|ASA|ANS|DA|ENK|NUF)\\b"


_FORM = re.compile(r"\s+(?:AS|ASA|ANS|DA|ENK|NUF)\b", re.I)
_CLASS = "A-Za-zÆØÅæøåı&.'’\\- ſK"  # as the pattern's class matches when case is ignored
_TAIL, _LETTER = re.compile(rf"[{_CLASS}]*\Z"), re.compile("[A-Za-zÆØÅæøåıſK]")


def entities_in(text: str | None) -> list[str]:
    """All matches of LEGAL_ENTITY from left to right, found from the legal forms backwards: the
    pattern itself tries 80 characters from every letter of a text."""
    out, pos = [], 0
    forms = [(m.start(), m.end()) for m in _FORM.finditer(text or "")]
    for i, (space, _) in enumerate(forms):
        # the body may take in blanks before the form's own one
        last = space
        while last + 1 < forms[i][1] and text[last] == " " and text[last + 1].isspace():
            last += 1
        low = max(pos, space - 81)
        run = low + _TAIL.search(text[low:space]).start()
        first = _LETTER.search(text, run, space)
        if not first or last - first.start() < 2:
            continue
        start, end = first.start(), None
        for e, z in forms[i:]:
            if e - start > 81:
                break
            if e - start >= 2 and not re.search(rf"[^{_CLASS}]", text[start:e]) or (e, z) == forms[i]:
                end = z
        out.append(" ".join(text[start:end].split("\n")) if "\n" in text[start:end] else text[start:end])
        pos = end
    return out


@F.pandas_udf(ArrayType(StringType()))
def _entities(text: pd.Series) -> pd.Series:
    return text.map(entities_in)


def legal_mentions(col: Column) -> Column:
    """Distinct names of legal entities in a text, as joined tokens, sorted."""
    # all names of a text are folded and cut to tokens in one go; a line break parts them
    lines = F.split(folded(F.array_join(_entities(col), "\n")), "\n")
    words = F.transform(lines, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "[^a-z0-9]+", " "), rf"(?<![a-z0-9])(?:[a-z0-9]|{'|'.join(LEGAL_WORDS)})(?![a-z0-9])", "")))
    return F.array_sort(F.array_distinct(F.filter(F.transform(words, lambda x: F.regexp_replace(x, " +", " ")), lambda x: x != "")))


def search_query(name: Column, number: Column, municipality: Column) -> Column:
    """Quoted name, number and place; null without a name or number."""
    tidy = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    n, o, m = tidy(name), F.regexp_replace(F.coalesce(number, F.lit("")), "[^0-9]", ""), tidy(municipality)
    return F.when((n != "") & (o != ""), F.concat(F.lit('"'), n, F.lit('" '), o, F.when(m != "", F.concat(F.lit(" "), m)).otherwise("")))


def headline_flags(title: Column) -> Column:
    """Reasons why a headline looks like clickbait, in fixed order."""
    t = F.trim(F.coalesce(title, F.lit("")))
    low, letters = F.lower(t), F.regexp_replace(t, r"[^\p{L}]", "")
    count = lambda c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    flags = [F.when(low.rlike(p), F.lit("clickbait_phrase:" + p.removeprefix(r"\b").removesuffix(r"\b"))) for p in CLICKBAIT]
    flags += [
        F.when(count("!") >= 2, F.lit("excessive_exclamation")), F.when(count("?") >= 2, F.lit("excessive_questions")),
        F.when((F.length(letters) >= 12) & (letters == F.upper(letters)), F.lit("all_caps_title")), F.when(F.length(t) < 15, F.lit("suspiciously_short")),
    ]
    return F.when(t == "", F.array(F.lit("empty_title"))).otherwise(F.array_compact(F.array(*flags)))


def phone(col: Column) -> Column:
    """Last eight digits, without a 47 prefix."""
    d = F.regexp_replace(F.coalesce(col, F.lit("")), "[^0-9]", "")
    return F.right(F.when((F.length(d) > 8) & d.startswith("47"), F.substr(d, F.lit(3))).otherwise(d), F.lit(8))


def email_domain(col: Column, generic: tuple[str, ...] = ("gmail.com", "hotmail.com", "outlook.com", "yahoo.com", "online.no")) -> Column:
    d = F.lower(F.substring_index(F.trim(col), "@", -1))
    return F.when(F.contains(col, F.lit("@")) & ~d.isin(*generic) & F.contains(d, F.lit(".")), d)


def number_nb(col: Column, most: float = 100_000.0) -> Column:
    """Norwegian decimals (blank thousands, comma), O read as 0; null outside 0..most."""
    t = F.regexp_replace(F.replace(F.upper(F.trim(col)), F.lit("O"), F.lit("0")), r"[\s ]", "")
    v = F.try_cast(F.replace(t, F.lit(","), F.lit(".")), "double") if hasattr(F, "try_cast") else F.replace(t, F.lit(","), F.lit(".")).try_cast("double")
    return F.when((v >= 0) & (v <= most), v)
