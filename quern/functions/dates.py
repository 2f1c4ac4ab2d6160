"""Dates in ISO, day-first and Norwegian text form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed month names.
MONTHS = ("januar", "februar", "mars", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "desember")


def parse_date(col: Column) -> Column:
    """ISO, d.m.Y or '5. mars 2024'; else null."""
    t = F.lower(F.trim(col))
    month = F.array_position(F.array(*(F.lit(m) for m in MONTHS)), F.regexp_extract(t, r"^[0-9]{1,2}\.? ([a-z]+) [0-9]{4}", 1))
    text = F.when(month > 0, F.concat_ws("-", F.regexp_extract(t, r"([0-9]{4})", 1), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(t, r"^([0-9]{1,2})", 1), 2, "0")))
    dotted = F.try_to_date(F.regexp_extract(t, r"^([0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})", 1), "d.M.yyyy")
    return F.coalesce(F.try_to_date(F.regexp_extract(t, r"^([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), "yyyy-MM-dd"), dotted, F.try_to_date(text, "yyyy-MM-dd"))


def fresh(at: Column, as_of: Column, days: int = 45, mode: str = "past") -> Column:
    """mode past: 0..days old; absolute: within days either way."""
    age = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(at.cast("timestamp"))
    span = F.lit(days * 86_400_000_000)
    return F.coalesce((age >= 0) & (age <= span) if mode == "past" else F.abs(age) <= span, F.lit(False))
