"""The one place that knows the wide domain table, its defaults and the partial-update types.

Every other module asks here for column names and types; none repeats them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: searchable columns, in table order -----------------------------------------
ARRAY_COLS = ["ns", "ns_domains", "txt", "mx", "addr", "geo", "asn", "status"]
BOOL_COLS = ["registered"]
CONTACT_ROLES = ["registrant", "admin", "tech"]
CONTACT_FIELDS = ["name", "phone", "email", "organization", "stateprovince", "country"]
CONTACT_COLS = [f"{role}_{part}" for role in CONTACT_ROLES for part in CONTACT_FIELDS]

_SEARCHABLE = {
    "domain": "string", "tld": "string", "registrar_id": "bigint",
    "registration_date": "timestamp", "expiration_date": "timestamp",
    "transfer_date": "timestamp", "last_changed_date": "timestamp",
    "hits_12m": "bigint", "visits_12m": "bigint", "visits_arr_12m": "array<bigint>",
    "hits_geo": "string", "pi_rank": "bigint",
    "last_modified": "timestamp", "modified_by": "string", "dns_scraped": "timestamp",
    "pm_username": "string", "pm_added": "timestamp", "pm_blacklisted": "timestamp",
    **{c: "string" for c in CONTACT_COLS},
    **{c: "array<string>" for c in ARRAY_COLS},
    **{c: "boolean" for c in BOOL_COLS},
}
_UPDATE_ONLY = {
    "dns_exists": "boolean", "rcode": "string", "zonefile_date": "date",
    "last_visit_date": "date", "pi_import_date": "date",
    "rdap_json": "string", "whois_text": "string", "registrar_name": "string",
    "registrant": "string", "registrant_id": "string",
    "eligibility_type": "string", "eligibility_name": "string", "eligibility_id": "string",
    "registrant_adr": "array<string>", "admin_adr": "array<string>", "tech_adr": "array<string>",
    "rdap_scraped": "timestamp", "whois_scraped": "timestamp",
}
ALL_COLS = list(_SEARCHABLE)
TABLE_TYPES: dict[str, str] = {**_SEARCHABLE, **_UPDATE_ONLY}
TABLE_COLS = list(TABLE_TYPES)

# string columns that are never NULL in the table: their default is the empty string
EMPTY_STRING_COLS = {"domain", "tld", "modified_by", "rcode", "rdap_json", "whois_text", "hits_geo"}

COLUMN_GROUPS = {
    "default": ["registered", "ns_domains", "registrar_id", "visits_12m", "pm_username", "last_modified"],
    "dns": ["ns", "ns_domains", "addr", "mx", "txt", "asn", "geo", "tld"],
    "registrant": [c for c in CONTACT_COLS if c.startswith("registrant_")],
    "admin": [c for c in CONTACT_COLS if c.startswith("admin_")],
    "tech": [c for c in CONTACT_COLS if c.startswith("tech_")],
    "traffic": ["visits_12m", "hits_12m", "hits_geo", "pi_rank"],
    "whois": ["status", "registrar_id", "registration_date", "expiration_date", "transfer_date",
              "last_changed_date", "pm_username", "pm_added", "pm_blacklisted"],
}


def default_value(name: str) -> Column:
    """Value a column takes in a row that no update has filled yet."""
    kind = TABLE_TYPES[name]
    if kind.startswith("array"):
        return F.array().cast(kind)
    if name in EMPTY_STRING_COLS:
        return F.lit("")
    return F.lit(None).cast(kind)


def table_schema() -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in TABLE_TYPES.items()))


# --- partial updates --------------------------------------------------------------------------
@dataclass(frozen=True)
class Field:
    """One column an update type may carry. `wire` is its name in the message when it differs."""

    name: str
    required: bool = True
    nullable: bool = False
    lower: bool = False
    wire: str | None = None

    @property
    def key(self) -> str:
        return self.wire or self.name


@dataclass(frozen=True)
class UpdateType:
    modified_by: str | None
    fields: list[Field] = field(default_factory=list)
    stamps: tuple[str, ...] = ()  # "scraped at" columns; absent means the arrival time

    @property
    def columns(self) -> list[str]:
        """Columns this type overwrites, the two bookkeeping ones included."""
        return [f.name for f in self.fields] + list(self.stamps) + ["modified_by", "last_modified"]


def _contacts(required: bool, rdap: bool) -> list[Field]:
    out = []
    for role in ("registrant", "tech", "admin"):
        for part in ("name", "organization", "stateprovince", "country", "phone", "email"):
            wire = f"{role}_state" if rdap and part == "stateprovince" else None
            out.append(Field(f"{role}_{part}", required=required, nullable=True, wire=wire))
        if rdap:
            out.append(Field(f"{role}_adr", required=required))
    return out


def _optional(*names: str) -> list[Field]:
    return [Field(n, required=False, nullable=True) for n in names]


UPDATE_TYPES: dict[str, UpdateType] = {
    "Result": UpdateType(None),
    "DNSResult": UpdateType("dns", [
        Field("addr"), Field("ns", lower=True), Field("txt"), Field("mx", lower=True),
        Field("dns_exists"), Field("rcode"), Field("ns_domains", lower=True),
    ], ("dns_scraped",)),
    "ZonefileResult": UpdateType("zonefile", [
        Field("ns", lower=True), Field("ns_domains", lower=True), Field("tld", lower=True),
        Field("zonefile_date", required=False),
    ]),
    "RDAPResult": UpdateType("rdap", [
        Field("rdap_json"), Field("registered"), Field("registration_date"),
        Field("expiration_date", nullable=True), Field("transfer_date", nullable=True),
        Field("last_changed_date", nullable=True),
        *_contacts(required=True, rdap=True),
        Field("registrar_id", nullable=True), Field("status"),
    ], ("rdap_scraped", "whois_scraped")),
    "RDAPNXResult": UpdateType("rdap", [Field("registered")], ("rdap_scraped", "whois_scraped")),
    "PIResult": UpdateType("pi", [
        Field("visits_12m"), Field("hits_12m"), Field("visits_arr_12m"), Field("last_visit_date"),
        Field("hits_geo"), Field("pi_rank"), Field("pi_import_date", required=False),
    ]),
    "WHOISResult": UpdateType("whois", [
        Field("whois_text"), Field("registered"), Field("last_changed_date", nullable=True),
        Field("registrar_name", nullable=True), Field("registrar_id"), Field("status"),
        *_optional("expiration_date", "registration_date"),
        *_contacts(required=False, rdap=False),
        *_optional("registrant", "registrant_id", "eligibility_type", "eligibility_name", "eligibility_id"),
    ], ("whois_scraped",)),
    "WHOISNXResult": UpdateType("whois", [Field("registered")], ("whois_scraped",)),
    "OwnershipResult": UpdateType("ownership", [
        Field("pm_username", nullable=True), Field("pm_blacklisted", required=False, nullable=True),
        Field("pm_added", required=False),
    ]),
}

def carried_together(columns: list[str]) -> list[list[str]]:
    """Columns grouped so that whole-type updates carry all of a group or none of it.

    `registered` stays alone: a rule adds it to updates that would not carry it.
    """
    groups: dict[tuple, list[str]] = {}
    for c in columns:
        carriers = tuple(n for n, t in UPDATE_TYPES.items() if c in t.columns)
        groups.setdefault((c,) if c == "registered" else carriers, []).append(c)
    return list(groups.values())


ERROR_SCHEMA = ("uuid string, domain string, error string, error_type string, file string, line int, "
                "traceback string, scraper string, topic string, timestamp timestamp")
SEARCH_SCHEMA = ("id bigint, criteria array<struct<col:string,match:string,value:string>>, "
                 "timestamp timestamp, search_results_id bigint")
TAG_SCHEMA = "id bigint, search_id bigint, name string, colour string, icon string, notes string"
