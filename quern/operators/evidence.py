"""Module states, channel security, ownership, addresses, facts, narratives and the adaptive loop."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed threat patterns and commercial words of channel texts.
THREATS = (
    r"\b(?:crypto|bitcoin|ethereum|btc|eth|usdt)\b", r"\b(?:giveaway|airdrop|free\s+tokens|doubler)\b", r"\b(?:forex\s+signals|whatsapp\s+investment|telegram\s+invest)\b",
    r"\b(?:guaranteed\s+profit|passive\s+income\s+bot)\b", r"\b(?:t\.me\/|wa\.me\/|whatsapp:\s*\+)\b", r"\b(?:claim\s+reward|connect\s+wallet|claim\s+bonus)\b",
    r"\b(?:pay\s+registration\s+fee|wire\s+money\s+for\s+equipment)\b", r"\b(?:scam\s+alert|fraud\s+exposed|boycott|fake\s+company|swindle)\b", r"\b(?:parody\s+account|not\s+affiliated\s+with|unofficial\s+fan)\b",
)
COMMERCIAL = (
    "official", "selskap", "bedrift", "tjenester", "produkter", "technology", "løsninger", "solutions", "customer", "partner", "ansatte", "karriere", "kontakt", "contact", "about us", "om oss",
    "nyheter", "pressemelding", "engineering", "design", "produksjon", "leverandør", "norway", "norge", "norwegian", "energy", "project", "business", "corp", "industry", "industri", "utvikling",
    "innovasjon", "report", "marked", "drift", "presentation", "group", "holdings", "media", "services", "system",
)
SHORT = 120  # a text under so many characters counts as harmless


def terminal_state(status: Column) -> Column:
    """A module's end state; a failed request never proves absence."""
    return F.when(status.isin("available", "not_applicable", "blocked"), status).when(status.isin("not_found", "absent", "not_available"), "not_available").otherwise("failed")


def availability_state(status: Column) -> Column:
    """A claim's state; keeps ambiguity, reads only found absence as absence."""
    s = F.lower(status)
    return F.when(s.isin("available", "not_applicable", "blocked", "ambiguous"), s).when(s.isin("not_found", "absent"), "not_available").otherwise("failed")


def channel_verdict(text: Column, company: Column, domain: Column) -> Column:
    """Struct(tier, risk, threats): any threat quarantines; else the verified
    domain in the text, or a commercial purpose, makes it authentic."""
    t = F.lower(F.coalesce(text, F.lit("")))
    threats = F.array_compact(F.array(*(F.nullif(F.regexp_extract(t, p, 0), F.lit("")) for p in THREATS)))
    site = F.regexp_replace(F.lower(F.coalesce(domain, F.lit(""))), r"^www\.", "")
    linked = (site != "") & F.contains(t, site)
    purpose = F.length(F.trim(t)) < SHORT
    for w in COMMERCIAL:
        purpose = purpose | F.contains(t, F.lit(w))
    purpose = purpose | ((F.coalesce(company, F.lit("")) != "") & F.contains(t, F.lower(company)))
    bad = F.size(threats) > 0
    tier = F.when(bad, "quarantined_threat").when(linked | purpose, "verified_safe_and_authentic").otherwise("quarantined_uncertain")
    return F.struct(tier.alias("tier"), F.when(bad, "critical").when(linked, "low").otherwise("medium").alias("risk"), threats.alias("threats"))


def compact(col: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), r"[^\p{L}\p{N}_]", "")


def ownership(org: Column, name: Column, public_ids: Column, registrant: Column) -> Column:
    plain = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")
    same = (plain(registrant) != "") & (plain(registrant) == plain(name))
    return F.when(F.exists(public_ids, lambda x: x == org), "org_number_match").when(same, "registrant_name_match").otherwise("registrant_unverified")


def same_address(street: Column, postcode: Column, municipality: Column, found: Column, found_postcode: Column, found_municipality: Column) -> Column:
    """A geocoded hit that is the registered address itself."""
    ok = (compact(street) != "") & postcode.rlike("^[0-9]{4}$") & (postcode == found_postcode)
    ok = ok & ((F.coalesce(municipality, F.lit("")) == "") | (municipality == found_municipality))
    return F.coalesce(ok & (compact(street) == compact(found)), F.lit(False))


def facts(rows: DataFrame, key: str, labels: dict[str, str]) -> DataFrame:
    """(key, label, value) of the fields that have one."""
    cells = F.array(*(F.struct(F.lit(label).alias("label"), F.col(c).cast("string").alias("value")) for label, c in labels.items()))
    return rows.select(key, F.explode(cells).alias("f")).select(key, "f.*").where("value is not null and value <> ''")


def narrative(rows: DataFrame) -> DataFrame:
    """A template summary; parts without a value are left out."""
    parts = F.concat_ws(
        " ", F.concat(F.col("name"), F.lit(" is registered in "), F.initcap("municipality"), F.lit(".")), F.concat(F.lit("It has "), F.col("employees"), F.lit(" registered employees.")),
        F.concat(F.lit("Its latest revenue is "), F.format_number("revenue", 0), F.lit(".")), F.when(F.col("annual_result") < 0, "The latest result is a loss.").when(F.col("annual_result") > 0, "The latest result is a profit."),
    )
    return rows.withColumn("summary", parts)


def adaptive_loop(strategies: list[str], run: Callable[[str], float], history: dict[str, list[float]] | None = None, weight: float = 0.35) -> list[tuple[str, float]]:
    """Every strategy once, always the one of the highest mean gain plus
    exploration bonus next (ties: listed first). run starts a Spark job and
    returns its gain; only the gains are kept on the driver."""
    seen = {s: list((history or {}).get(s, [])) for s in strategies}
    left, done = list(strategies), []
    while left:
        total = max(1, sum(map(len, seen.values())))
        rank = {s: (sum(g) / len(g) if g else 0.0) + weight * math.sqrt(math.log(total + 1) / (len(g) + 1)) for s, g in seen.items()}
        best = max(left, key=lambda s: (rank[s], -strategies.index(s)))
        left.remove(best)
        gain = run(best)
        seen[best].append(gain)
        done.append((best, gain))
    return done
