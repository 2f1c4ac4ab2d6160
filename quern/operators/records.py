"""Official JSON bodies as typed columns: roles, groups, locations, entities, history years."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed role descriptions that stand in for a missing code.
CHAIR = ("styrets leder", "styreleder", "chair")
CEO = ("daglig leder", "administrerende direktør", "ceo", "managing director")
BOARD = ("styremedlem", "nestleder")

_NAME = "navn: struct<fornavn: string, mellomnavn: string, etternavn: string>"
_CODE = "type: struct<kode: string, beskrivelse: string>"
ROLES = f"rollegrupper array<struct<{_CODE}, sistEndret: string, roller: array<struct<{_CODE}, person: struct<{_NAME}>, enhet: struct<organisasjonsnummer: string, navn: string>, avregistrert: boolean>>>>"


def roles(body: Column) -> Column:
    """array of (name, organisation_number, role_code, role, group_code, last_changed, inactive), in order; birth dates are not read."""
    groups = F.from_json(body, ROLES)["rollegrupper"]
    full = lambda r: F.nullif(F.concat_ws(" ", *(F.nullif(r["person"]["navn"][p], F.lit("")) for p in ("fornavn", "mellomnavn", "etternavn"))), F.lit(""))
    one = lambda g, r: F.struct(
        F.coalesce(full(r), F.nullif(r["enhet"]["navn"], F.lit(""))).alias("name"), r["enhet"]["organisasjonsnummer"].alias("organisation_number"), r["type"]["kode"].alias("role_code"), r["type"]["beskrivelse"].alias("role"),
        g["type"]["kode"].alias("group_code"), g["sistEndret"].alias("last_changed"), F.coalesce(r["avregistrert"], F.lit(False)).alias("inactive"),
    )
    return F.coalesce(F.flatten(F.transform(groups, lambda g: F.transform(F.coalesce(g["roller"], F.array()), lambda r: one(g, r)))), F.array().cast("array<struct<name:string,organisation_number:string,role_code:string,role:string,group_code:string,last_changed:string,inactive:boolean>>"))


def leaders(found: Column) -> Column:
    """struct(chair, ceo, board): the first active chair and chief, the sorted distinct board; a missing code goes by its description."""
    code, said = (lambda r: F.upper(F.coalesce(r["role_code"], F.lit("")))), (lambda r: F.lower(F.trim(F.coalesce(r["role"], F.lit("")))))
    fits = lambda r, codes, names: code(r).isin(*codes) | ((code(r) == "") & said(r).isin(*names))
    live = F.transform(F.filter(found, lambda r: ~r["inactive"] & r["name"].isNotNull()), lambda r: F.struct(r["name"].alias("name"), fits(r, ("LEDE",), CHAIR).alias("chair"), fits(r, ("DAGL",), CEO).alias("ceo"), fits(r, ("MEDL", "NEST"), BOARD).alias("board")))
    of = lambda rows, post: F.transform(F.filter(rows, lambda r: r[post]), lambda r: r["name"])
    pick = lambda rows: F.struct(F.try_element_at(of(rows, "chair"), F.lit(1)).alias("chair"), F.try_element_at(of(rows, "ceo"), F.lit(1)).alias("ceo"), F.array_sort(F.array_distinct(of(rows, "board"))).alias("board"))
    # as a variable of a function the parsed roles are made once, not once for every field that is read
    return F.get(F.transform(F.array(live), pick), F.lit(0))


_UNIT = "struct<organisasjonsnummer: string, navn: string, name: string, eierandel: double, andel: double>"
GROUP = f"morselskap {_UNIT}, parent {_UNIT}, datterselskaper array<{_UNIT}>, subsidiaries array<{_UNIT}>, underenheter array<{_UNIT}>"


def group_links(body: Column) -> Column:
    """struct(parent, parent_name, subsidiaries): an unknown share stays null."""
    g = F.from_json(body, GROUP)
    some = lambda x: F.when(F.size(x) > 0, x)
    subs = F.coalesce(some(g["datterselskaper"]), some(g["subsidiaries"]), some(g["underenheter"]), F.array().cast(f"array<{_UNIT}>"))
    parent = F.coalesce(g["morselskap"], g["parent"])
    rows = F.transform(subs, lambda s: F.struct(s["organisasjonsnummer"].alias("organisation_number"), s["navn"].alias("name"), F.coalesce(s["eierandel"], s["andel"]).alias("ownership_percentage")))
    return F.struct(parent["organisasjonsnummer"].alias("parent"), F.coalesce(F.nullif(parent["navn"], F.lit("")), parent["name"]).alias("parent_name"), rows.alias("subsidiaries"))


def parents(links, key: str = "parent"):
    """(organisation_number, parent): one hop up, from rows of parent and subsidiaries."""
    return links.select(F.col(key).alias("parent"), F.explode("subsidiaries").alias("s")).select(F.col("s.organisation_number").alias("organisation_number"), "parent", F.col("s.ownership_percentage").alias("ownership_percentage"))


_ADDRESS = "struct<adresse: array<string>, postnummer: string, poststed: string, kommune: string>"
_INDUSTRY = "struct<kode: string, beskrivelse: string>"
LOCATIONS = f"_embedded struct<underenheter: array<struct<organisasjonsnummer: string, navn: string, beliggenhetsadresse: {_ADDRESS}, postadresse: {_ADDRESS}, naeringskode1: {_INDUSTRY}, antallAnsatte: int>>>"


def locations(body: Column) -> Column:
    rows = F.from_json(body, LOCATIONS)["_embedded"]["underenheter"]
    return F.transform(rows, lambda u: F.struct(u["organisasjonsnummer"].alias("organisation_number"), u["navn"].alias("name"), F.coalesce(u["beliggenhetsadresse"], u["postadresse"]).alias("address"), u["naeringskode1"].alias("industry"), u["antallAnsatte"].alias("employees")))


ENTITY = f"organisasjonsnummer string, navn string, organisasjonsform {_INDUSTRY}, antallAnsatte int, konkurs boolean, underAvvikling boolean, hjemmeside string, epostadresse string, telefon string, naeringskode1 {_INDUSTRY}, forretningsadresse {_ADDRESS}, postadresse {_ADDRESS}, sisteInnsendteAarsregnskap string, historiskeNavn array<struct<navn: string>>"


def entity(body: Column) -> Column:
    e = F.from_json(body, ENTITY)
    names = {"organisasjonsnummer": "organisation_number", "navn": "name", "antallAnsatte": "employees", "konkurs": "bankrupt", "underAvvikling": "liquidating", "hjemmeside": "website", "epostadresse": "email", "telefon": "phone", "naeringskode1": "industry", "forretningsadresse": "business_address", "postadresse": "postal_address", "sisteInnsendteAarsregnskap": "latest_submitted_accounts"}
    historic = F.filter(F.transform(F.coalesce(e["historiskeNavn"], F.array().cast("array<struct<navn:string>>")), lambda n: F.trim(F.coalesce(n["navn"], F.lit("")))), lambda n: n != "")
    return F.struct(*(e[k].alias(v) for k, v in names.items()), e["organisasjonsform"]["kode"].alias("legal_form"), historic.alias("historic_names"))


def former_names(current: Column, previous: Column, known: Column, historic: Column) -> Column:
    """Names before the current one, in order: those known, the one that is replaced, historic ones; each once."""
    known = F.coalesce(known, F.array().cast("array<string>"))
    old = F.when(F.coalesce(previous, F.lit("")).isin("") | (previous == current), F.array().cast("array<string>")).otherwise(F.array(previous))
    return F.array_distinct(F.concat(known, old, F.filter(historic, lambda n: n != current)))


def history_years(body: Column) -> Column:
    """struct(years, pdf_years): distinct digits-only years ascending, and newest first."""
    years = F.array_sort(F.array_distinct(F.filter(F.coalesce(F.from_json(body, "array<string>"), F.array().cast("array<string>")), lambda y: y.rlike("^[0-9]+$"))))
    return F.struct(years.alias("years"), F.reverse(years).alias("pdf_years"))
