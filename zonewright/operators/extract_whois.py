"""Text WHOIS responses to typed updates."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions import text
from zonewright.operators.once import once
from zonewright.operators.skew import salted_join

# fixed values: phrases (case counts) that mean "no such name"
NO_MATCH = [
    "No match for",
    "Domain status: available",
    "Domain status: No Object Found",
    "% nothing found",
    "% No entries found",
    "No entries found in the AFNIC Database",
    "The queried object does not exist",
    "This domain has been reserved by the registry, and is not available for registration",
    "Invalid query or domain name not known",
    "The requested domain was not found in",
    "DOMAIN NOT FOUND",
    "Not found:",
    "NOT FOUND",
    "Status: free",
    "Status: Not Registered",
    "is free",
    "Status: AVAILABLE",
    "No Data Found",
    "No information available about domain name",
    "This domain name has not been registered.",
    "query_status: 220 Available",
    "Domain not found",
]

# fixed values: line labels of each field
_CONTACT_LABELS = {"name": ["Name", "Contact Name"], "organization": ["Organization"], "stateprovince": ["State/Province"],
                   "country": ["Country"], "phone": ["Phone"], "email": ["Email"]}
LABELS = {
    "last_changed_date": ["Updated Date", "Last Modified"],
    "registration_date": ["Registration Date", "Creation Date"],
    "expiration_date": ["Registrar Registration Expiration Date", "Registry Expiry Date", "Expiration Date"],
    "status": ["Status", "Domain Status"],
    "registrar_name": ["Registrar Name", "Registrar"],
    "registrar_id": ["Registrar IANA ID"],
    "registrant": ["Registrant"],
    "registrant_id": ["Registrant ID"],
    **{f"{role.lower()}_{field}": [f"{role} {label}" for label in labels]
       for role in ("Registrant", "Admin", "Tech") for field, labels in _CONTACT_LABELS.items()},
    "eligibility_type": ["Eligibility Type"],
    "eligibility_name": ["Eligibility Name"],
    "eligibility_id": ["Eligibility ID"],
}
DATES = ("last_changed_date", "registration_date", "expiration_date")

def is_no_match(body: Column) -> Column:
    return reduce(lambda a, b: a | b, [body.contains(p) for p in NO_MATCH])


def label_lines(body: Column) -> Column:
    """Lines `label: value` of a whole text in order, as a list of (label, value).

    The label is all that stands before a line's first colon; lines without a value are left out.
    """
    lines = F.split(F.translate(body, text.LINE_ENDS, "\n" * len(text.LINE_ENDS)), "\n")
    labelled = F.filter(lines, lambda line: line.contains(":"))
    pairs = F.transform(labelled, lambda line: F.struct(
        F.ltrim(F.substring_index(line, ":", 1), F.lit(text.SPACE)).alias("label"),
        F.trim(F.substr(line, F.locate(":", line) + 1), F.lit(text.SPACE)).alias("value")))
    return F.filter(pairs, lambda p: p["value"] != "")


def known_lines(body: Column) -> Column:
    """(field, value) of the label lines of the fields we keep, the last line first.

    The same lines as `label_lines` finds, but one pattern picks out ours before any is taken apart.
    """
    own = [(label, name) for name, labels in LABELS.items() for label in labels]
    field_of = F.create_map(*[F.lit(part) for pair in own for part in pair])
    ours = "|".join(re.escape(label) for label, _ in own)
    known = F.filter(F.split(body, f"[{text.LINE_ENDS}]"), lambda line: line.rlike(f"^[{text.SPACE}]*+(?:{ours}):[{text.SPACE}]*+."))
    return F.reverse(F.transform(known, lambda line: F.struct(
        F.element_at(field_of, F.ltrim(F.substring_index(line, ":", 1), F.lit(text.SPACE))).alias("field"),
        F.trim(F.substr(line, F.locate(":", line) + 1), F.lit(text.SPACE)).alias("value"))))


def parse_fields(lines: Column) -> dict[str, Column]:
    """Field texts from known lines: the last value given; for status all of them, first words only.

    A field's last line is found by its position in the list of fields, so no field looks at the values of others.
    """
    names, values = lines["field"], lines["value"]
    fields = {name: F.get(values, (F.array_position(names, name) - 1).cast("int")) for name in LABELS}
    given = F.reverse(F.filter(lines, lambda p: p["field"] == "status"))
    fields["status"] = F.transform(given, lambda p: F.element_at(text.words(p["value"]), 1))
    return fields


def extract_whois(captures: DataFrame, registrar_ids: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Captures `(domain, whois_text)` to (records, no-such-name, rejected with reason).

    `registrar_ids(registrar_name, registrar_id)` supplies the id where the text has a registrar
    but no id. A record needs a last change date, a registrar, its numeric id and a status.
    """
    body = once(captures.select("domain", "whois_text"), _nx=is_no_match(F.col("whois_text")))
    nx = body.where(F.col("_nx")).select(F.lower("domain").alias("domain"), F.lit("WHOISNXResult").alias("type"),
                                         F.lit("whois").alias("modified_by"), F.lit(False).alias("registered"))
    texts = body.where(~F.col("_nx")).select("domain", "whois_text")
    lines = once(texts, _lines=known_lines(F.col("whois_text")))
    raw = once(lines, **{f"_{n}": c for n, c in parse_fields(F.col("_lines")).items()}).drop("_lines")
    ids = registrar_ids.select(F.col("registrar_name").alias("_name"), F.col("registrar_id").cast("string").alias("_found"))
    # only rows without an id of their own have a key to look up; the others pass through
    keyed = raw.withColumn("_name", F.when(F.col("_registrar_id").isNull(), F.col("_registrar_name")))
    both = salted_join(keyed, ids, ["_name"], F.col("domain")).drop("_name")

    the_id = F.coalesce("_registrar_id", "_found")
    number = the_id.try_cast("bigint")
    dates = {d: text.iso_timestamp(F.col(f"_{d}")) for d in DATES}
    reasons = F.array_compact(F.array(
        F.when(F.col("_last_changed_date").isNull(), F.lit("missing last_changed_date")),
        F.when(F.col("_registrar_name").isNull(), F.lit("missing registrar_name")),
        F.when(the_id.isNull() & F.col("_registrar_name").isNotNull(), F.lit("unknown registrar")),
        F.when(the_id.isNull() & F.col("_registrar_name").isNull(), F.lit("missing registrar_id")),
        F.when(the_id.isNotNull() & number.isNull(), F.lit("bad registrar_id")),
        F.when(F.size("_status") == 0, F.lit("missing status")),
        *[F.when(F.col(f"_{d}").isNotNull() & v.isNull(), F.lit(f"bad {d}")) for d, v in dates.items()]))
    judged = once(both, _reasons=reasons)
    plain = [n for n in LABELS if n not in DATES and n not in ("registrar_id", "status")]
    records = judged.where(F.size("_reasons") == 0).select(
        F.lower("domain").alias("domain"), F.lit("WHOISResult").alias("type"), F.lit("whois").alias("modified_by"),
        "whois_text", F.lit(True).alias("registered"), *[v.alias(d) for d, v in dates.items()],
        number.alias("registrar_id"), F.col("_status").alias("status"), *[F.col(f"_{n}").alias(n) for n in plain])
    rejected = judged.where(F.size("_reasons") > 0).select("domain", F.array_join("_reasons", "; ").alias("reason"))
    return records, nx, rejected
