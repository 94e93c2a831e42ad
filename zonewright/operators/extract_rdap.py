"""RDAP responses (JSON) to typed updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions import text
from zonewright.operators.once import once

THROTTLED = [429, 422, 403]
IANA_ID = "IANA Registrar ID"

# Members are declared in both spellings servers use. JSON is read with case-sensitive names, but a
# struct cannot hold two names that differ in case alone when the session ignores case, so the odd
# spellings are renamed in the text first.
_ID = "struct<type:string,identifier:string,other_identifier:string>"
_ENTITIES = (f"array<struct<handle:string,roles:array<string>,publicIds:array<{_ID}>,other_public_ids:array<{_ID}>,"
             "vcardArray:array<string>>>")
_SHAPE = (f"struct<events:array<struct<eventAction:string,eventDate:string>>,status:string,publicIds:array<{_ID}>,"
          f"entities:{_ENTITIES}>")


def parse(body: Column) -> Column:
    renamed = F.regexp_replace(body, r'"Identifier"(\s*:)', r'"other_identifier"$1')
    renamed = F.regexp_replace(renamed, r'"publicIDs"(\s*:)', r'"other_public_ids"$1')
    return F.from_json(renamed, _SHAPE)


def event_date(doc: Column, action: str) -> Column:
    """Date text of the first event with that action."""
    return F.get(F.filter(doc["events"], lambda e: e["eventAction"] == action), F.lit(0))["eventDate"]


def status_list(doc: Column) -> Column:
    """Status member as a list, whether it came as list, single text or not at all."""
    raw = doc["status"]
    return (F.when(raw.isNull(), F.array().cast("array<string>"))
            .when(raw.startswith("["), F.from_json(raw, "array<string>")).otherwise(F.array(raw)))


def _iana(ids: Column) -> Column:
    hit = F.get(F.filter(ids, lambda i: i["type"] == IANA_ID), F.lit(0))
    return F.coalesce(hit["identifier"], hit["other_identifier"])


def registrar_id(doc: Column) -> Column:
    """IANA id from the top level, else from the first registrar entity that has one."""
    registrars = F.filter(doc["entities"], lambda e: F.array_contains(e["roles"], "registrar"))
    inner = F.transform(registrars, lambda e: _iana(F.coalesce(e["publicIds"], e["other_public_ids"])))
    return F.coalesce(_iana(doc["publicIds"]), F.get(F.filter(inner, lambda i: i.isNotNull()), F.lit(0)))


def _with_role(entities: Column, role: str) -> Column:
    """Entities of a role; administrative and technical ones by the start of the role's name."""
    def fits(entity: Column) -> Column:
        hit = F.exists(entity["roles"], lambda r: r == role if role == "registrant" else r.startswith(role))
        return F.coalesce(hit, F.lit(False))
    return F.filter(entities, fits)


def opened(doc: Column) -> Column:
    """Entities with their card parsed: a list of properties, each a list of raw JSON texts."""
    cards = "array<array<string>>"
    return F.transform(F.coalesce(doc["entities"], F.array().cast(_ENTITIES)), lambda e: F.struct(
        e["roles"].alias("roles"), F.coalesce(e["handle"], F.lit("")).alias("handle"),
        F.from_json(F.get(e["vcardArray"], F.lit(1)), cards).alias("card")))


def _properties(entity: Column, name: str) -> Column:
    return F.filter(entity["card"], lambda p: F.get(p, F.lit(0)) == name)


def _first(properties: Column) -> Column:
    return F.try_element_at(F.get(properties, F.lit(0)), F.lit(-1))


def _phone(tel: Column, handle: Column) -> Column:
    """Last element of the property; the second one for handles ending in .info."""
    prop = F.get(tel, F.lit(0))
    return F.when(handle.endswith(".info") & (F.size(prop) > 1), F.get(prop, F.lit(1))).otherwise(F.try_element_at(prop, F.lit(-1)))


def _addresses(adr: Column) -> Column:
    return F.when(F.size(adr) > 0, F.transform(adr, lambda p: F.try_element_at(p, F.lit(-1))))


def _parts(addresses: Column) -> Column:
    """Components of the first address that is a list and not empty."""
    lists = F.filter(addresses, lambda a: a.startswith("[") & (F.regexp_replace(a, r"\s", "") != "[]"))
    return F.from_json(F.get(lists, F.lit(0)), "array<string>")


def digested(entities: Column) -> Column:
    """Per entity its roles and the contact details its card gives, NULL for what it lacks."""
    def part(parts: Column, back: int) -> Column:
        found = F.try_element_at(parts, F.lit(-back))
        return F.when(found != "", found)

    # in steps, so that a card is searched once for each property and an address list is made once
    cards = F.transform(entities, lambda e: F.struct(
        e["roles"].alias("roles"), e["handle"].alias("handle"), *[_properties(e, n).alias(n) for n in ("fn", "org", "tel", "email", "adr")]))
    named = F.transform(cards, lambda e: F.struct(
        e["roles"].alias("roles"), _first(e["fn"]).alias("name"), _first(e["org"]).alias("organization"),
        _phone(e["tel"], e["handle"]).alias("phone"), _first(e["email"]).alias("email"), _addresses(e["adr"]).alias("adr")))
    plain = F.transform(named, lambda e: F.struct(
        *[e[n].alias(n) for n in ("roles", "name", "organization", "phone", "email", "adr")], _parts(e["adr"]).alias("parts")))
    return F.transform(plain, lambda e: F.struct(
        *[e[n].alias(n) for n in ("roles", "name", "organization", "phone", "email", "adr")],
        part(e["parts"], 3).alias("stateprovince"), part(e["parts"], 1).alias("country")))


ROLES = {"registrant": "registrant", "admin": "admin", "tech": "tech"}


def by_role(details: Column) -> dict[str, Column]:
    """Details of the entities of each role, under the role's name in our columns."""
    return {ours: _with_role(details, role) for ours, role in ROLES.items()}


def contacts(roles: dict[str, Column]) -> dict[str, Column]:
    """Details of the three roles; a later entity overrides an earlier one with what it has."""
    out: dict[str, Column] = {}
    for ours, mine in roles.items():
        for name in ("name", "organization", "phone", "email", "adr", "stateprovince", "country"):
            given = F.filter(mine[name], lambda v: v.isNotNull())
            out[f"{ours}_{name}"] = F.try_element_at(given, F.lit(-1))
        out[f"{ours}_adr"] = F.coalesce(out[f"{ours}_adr"], F.array().cast("array<string>"))
    return out


def outcome(status_code: Column) -> Column:
    """record, nx, throttled or error, by HTTP status."""
    return (F.when(status_code == 200, "record").when(status_code == 404, "nx")
            .when(status_code.isin(*THROTTLED), "throttled").otherwise("error"))


def parse_columns(doc: Column) -> dict[str, Column]:
    expiry = F.coalesce(F.when(event_date(doc, "expiration") != "", event_date(doc, "expiration")),
                        event_date(doc, "soft expiration"))
    return {"registration_date": event_date(doc, "registration"), "expiration_date": expiry,
            "transfer_date": event_date(doc, "transfer"), "last_changed_date": event_date(doc, "last changed")}


def extract_rdap(captures: DataFrame) -> dict[str, DataFrame]:
    """Captures `(domain, status_code, rdap_json)` to frames: records, nx, throttled, failed, rejected."""
    base = captures.withColumn("_outcome", outcome(F.col("status_code")))
    head = [F.lower("domain").alias("domain")]
    nx = base.where(F.col("_outcome") == "nx").select(
        *head, F.lit("RDAPNXResult").alias("type"), F.lit("rdap").alias("modified_by"), F.lit(False).alias("registered"))
    throttled = base.where(F.col("_outcome") == "throttled").select(*head, "status_code")
    failed = base.where(F.col("_outcome") == "error").select(*head, "status_code")

    docs = once(base.where(F.col("_outcome") == "record").select("domain", "rdap_json"), _doc=parse(F.col("rdap_json")))
    docs = once(once(docs, _open=opened(F.col("_doc"))), _who=digested(F.col("_open")))
    docs = once(docs, **{f"_of_{n}": c for n, c in by_role(F.col("_who")).items()})
    doc = F.col("_doc")
    raw_dates = parse_columns(doc)
    raw = once(docs, **{f"_{n}": c for n, c in raw_dates.items()}, _id=registrar_id(doc), status=status_list(doc),
               _broken=doc.isNull() | doc["events"].isNull() | doc["entities"].isNull(),
               **contacts({n: F.col(f"_of_{n}") for n in ROLES})).drop("_doc", "_open", "_who", *[f"_of_{n}" for n in ROLES])
    dates = {d: text.iso_timestamp(F.col(f"_{d}")) for d in raw_dates}
    number = F.col("_id").try_cast("bigint")
    reasons = F.array_compact(F.array(
        F.when(F.col("_broken"), F.lit("not an RDAP domain object")),
        F.when(~F.col("_broken") & F.col("_registration_date").isNull(), F.lit("missing registration_date")),
        F.when(F.col("_id").isNotNull() & number.isNull(), F.lit("bad registrar_id")),
        *[F.when(F.col(f"_{d}").isNotNull() & v.isNull(), F.lit(f"bad {d}")) for d, v in dates.items()]))
    judged = once(raw, _reasons=reasons)
    keep = [c for c in raw.columns if not c.startswith("_") and c not in ("domain", "rdap_json")]
    records = judged.where(F.size("_reasons") == 0).select(
        *head, F.lit("RDAPResult").alias("type"), F.lit("rdap").alias("modified_by"), "rdap_json",
        F.lit(True).alias("registered"), *[v.alias(d) for d, v in dates.items()], number.alias("registrar_id"), *keep)
    rejected = judged.where(F.size("_reasons") > 0).select(*head, F.array_join("_reasons", "; ").alias("reason"))
    return {"records": records, "nx": nx, "throttled": throttled, "failed": failed, "rejected": rejected}


def retry_requests(throttled: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """Requests again for names that were turned away, with the attempt counted up."""
    attempt = F.coalesce(F.col("attempt"), F.lit(0)) + 1 if "attempt" in throttled.columns else F.lit(1)
    again = throttled.select(F.lit("scrape.rdap").alias("topic"), F.col("domain").alias("key"),
                             F.lit("{}").alias("value"), attempt.cast("int").alias("attempt"))
    return again if max_attempts is None else again.where(F.col("attempt") <= max_attempts)
