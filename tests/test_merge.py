"""Fold, merge, decode, history on small frames."""

import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from zonewright import schema
from zonewright.operators import history, merge, snapshots
from zonewright.operators.names import Suffixes

T0 = datetime(2024, 5, 1, 12, 0)
COLS = ["tld", "registered", "registrar_name", "visits_12m", "ns"]
DDL = "seq bigint, domain string, fields array<string>, tld string, registered boolean, registrar_name string, visits_12m bigint, ns array<string>"


def _updates(spark, rows):
    full = []
    for seq, domain, values in rows:
        full.append((seq, domain, list(values), *[values.get(c) for c in COLS]))
    return spark.createDataFrame(full, DDL)


def _current(spark, rows):
    return spark.createDataFrame([(d, *[v.get(c) for c in COLS]) for d, v in rows],
                                 "domain string, tld string, registered boolean, registrar_name string, visits_12m bigint, ns array<string>")


def _versions(df):
    return {(r["domain"], r["seq"]): tuple(r[c] for c in COLS) for r in df.collect()}


def test_merge_overlays_and_defaults(spark):
    cur = _current(spark, [("a.com", {"tld": "com", "registered": True, "registrar_name": "R", "visits_12m": 5, "ns": ["x"]})])
    up = _updates(spark, [(1, "a.com", {"registrar_name": None}), (2, "a.com", {"visits_12m": 9}), (3, "b.com", {"registered": False})])
    got = _versions(merge.merge_updates(cur, up, COLS))
    assert got[("a.com", 1)] == ("com", True, None, 5, ["x"])  # explicit NULL overwrites
    assert got[("a.com", 2)] == ("com", True, None, 9, ["x"])  # and stays; later update keeps it
    assert got[("b.com", 3)] == ("", False, None, None, [])  # a new row starts from the defaults


def _random_updates(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        values = {c: v for c, v in [("tld", "com"), ("registered", rnd.choice([True, False, None])), ("registrar_name", rnd.choice("AB")),
                                    ("visits_12m", rnd.randrange(9)), ("ns", [str(rnd.randrange(3))])] if rnd.random() < 0.4}
        out.append((i, "hot" if rnd.random() < 0.5 else f"d{rnd.randrange(6)}", values))
    return out


def test_fold_in_one_or_two_batches_and_in_blocks(spark):
    rows = _random_updates(120, 1)
    empty = _current(spark, [])
    whole = _versions(merge.merge_updates(empty, _updates(spark, rows), COLS))
    assert _versions(merge.merge_updates(empty, _updates(spark, rows), COLS, blocks=10)) == whole
    first = merge.merge_updates(empty, _updates(spark, rows[:60]), COLS)
    latest = {}
    for (d, s), v in sorted(_versions(first).items(), key=lambda kv: kv[0][1]):
        latest[d] = dict(zip(COLS, v))
    second = merge.merge_updates(_current(spark, list(latest.items())), _updates(spark, rows[60:]), COLS)
    assert {**_versions(first), **_versions(second)} == whole


def _message(seq, key, **doc):
    return (seq, key, json.dumps(doc), T0)


MSG = "seq bigint, key string, value string, arrived timestamp"


def test_decode(spark):
    dns = dict(type="DNSResult", domain="A.com", addr=["1.2.3.4"], ns=["NS1.X.com"], txt=[], mx=["MX.x.com"], dns_exists=True,
               rcode="NOERROR", ns_domains=["x.com"], dns_scraped="2024-01-02T03:04:05")
    rows = [_message(1, "A.com", **dns), _message(2, None, **{**dns, "addr": "1.2.3.4"}),
            _message(3, "b.com", type="RDAPNXResult", domain="b.com", registered=False, modified_by="rdap"),
            _message(4, "b.com", type="Nope", domain="b.com"), (5, "c.com", "{broken", T0),
            _message(6, "c.com", type="WHOISNXResult", domain="c.com"), _message(7, "d.com", type="Result", domain="d.com", modified_by="csv_import"),
            _message(8, "d.com", type="Result", domain="d.com"), _message(9, "e.com", type="Owned", pm_username=None, pm_blacklisted=None)]
    good, bad = merge.decode_updates(spark.createDataFrame(rows, MSG), {"Owned": "OwnershipResult"})
    got = {r["seq"]: r for r in good.collect()}
    assert set(got) == {1, 3, 7, 9}
    assert got[1]["domain"] == "a.com" and got[1]["ns"] == ["ns1.x.com"] and got[1]["mx"] == ["mx.x.com"]
    assert got[1]["modified_by"] == "dns" and got[1]["dns_scraped"] == datetime(2024, 1, 2, 3, 4, 5) and got[1]["last_modified"] == T0
    assert set(got[1]["fields"]) == set(schema.UPDATE_TYPES["DNSResult"].columns)
    assert got[3]["registered"] is False and got[3]["whois_scraped"] == T0
    assert got[9]["type"] == "OwnershipResult" and got[9]["pm_blacklisted"] is None and got[9]["pm_added"] == T0
    reasons = {r["seq"]: r["reason"] for r in bad.collect()}
    assert reasons == {2: "bad addr", 4: "unknown type", 5: "not a JSON object", 6: "missing registered", 8: "missing modified_by"}


def test_decode_parsed_only(spark):
    doc = dict(type="WHOISResult", whois_text="t", registered=True, last_changed_date=None, registrar_name="R", registrar_id="7", status=["ok"])
    msgs = spark.createDataFrame([_message(1, "a.com", **doc)], MSG)
    all_fields = merge.decode_updates(msgs)[0].first()
    some = merge.decode_updates(msgs, parsed_only=True)[0].first()
    assert "expiration_date" in all_fields["fields"] and "expiration_date" not in some["fields"]
    assert "last_changed_date" in some["fields"] and some["registrar_id"] == 7 and "whois_scraped" in some["fields"]


def test_encode_then_decode(spark):
    rows = [_message(1, "a.com", type="RDAPNXResult", domain="a.com", registered=False),
            _message(2, "b.com", type="PIResult", domain="b.com", visits_12m=1, hits_12m=2, visits_arr_12m=[1], last_visit_date="2024-01-01",
                     hits_geo='A"U', pi_rank=3)]
    first = merge.decode_updates(spark.createDataFrame(rows, MSG))[0]
    wire = merge.encode_updates(first).withColumn("seq", F.when(F.col("key") == "a.com", 1).otherwise(2).cast("bigint")) \
        .withColumn("arrived", F.lit(T0).cast("timestamp"))
    again, bad = merge.decode_updates(wire)
    assert bad.count() == 0
    assert sorted(map(str, again.select(*first.columns).collect())) == sorted(map(str, first.collect()))


def test_encode_then_decode_wire_names_and_odd_domains(spark):
    roles = ("registrant", "tech", "admin")
    contacts = {f"{r}_{p}": f"{r} {p}" for r in roles for p in ("name", "organization", "state", "country", "phone", "email")}
    domain = 'q"b\\c.com'
    doc = dict(type="RDAPResult", domain=domain, rdap_json='{"a":"\\\\"}', registered=True, registration_date="2024-01-01T00:00:00",
               expiration_date=None, transfer_date=None, last_changed_date=None, **contacts, **{f"{r}_adr": ["x"] for r in roles},
               registrar_id=7, status=["ok"])
    first = merge.decode_updates(spark.createDataFrame([_message(1, domain, **doc)], MSG))[0]
    wire = merge.encode_updates(first).select(F.lit(1).cast("bigint").alias("seq"), "key", "value", F.lit(T0).cast("timestamp").alias("arrived"))
    again, bad = merge.decode_updates(wire)
    assert bad.count() == 0
    assert list(map(str, again.select(*first.columns).collect())) == list(map(str, first.collect()))
    assert again.first()["registrant_stateprovince"] == "registrant state" and again.first()["domain"] == domain


def _table_rows(spark, rows):
    return spark.createDataFrame(rows, "domain string, tld string").select(
        "domain", "tld", *[schema.default_value(c).alias(c) for c in schema.TABLE_COLS if c not in ("domain", "tld")])


def test_apply_updates_rules(spark):
    s = Suffixes.of(spark, ["com", "net"])
    dns = dict(type="DNSResult", addr=["192.0.2.1"], ns=["ns1.x.com"], txt=[], mx=[], dns_exists=True, rcode="NOERROR", ns_domains=["x.com"])
    zone = dict(type="ZonefileResult", ns=[], ns_domains=[], tld="zz", zonefile_date="2024-01-01")
    nx = dict(type="RDAPNXResult", registered=False)
    rows = [_message(1, "a.com", **dns), _message(2, "b.zz", **nx), _message(3, "b.zz", **zone), _message(4, "b.zz", **nx),
            _message(5, "c.zz", **nx), _message(6, "d.zz", **nx)]
    updates, _ = merge.decode_updates(spark.createDataFrame(rows, MSG))
    versions, rejected = merge.apply_updates(_table_rows(spark, [("d.zz", "zz")]), updates, s)
    got = {r["seq"]: r for r in versions.collect()}
    assert got[1]["registered"] is True and got[1]["tld"] == "com"  # resolves, so registered; suffix filled
    assert set(got) == {1, 3, 4, 6} and got[4]["tld"] == "zz" and got[4]["registered"] is False
    assert got[3]["registered"] is None  # the rejected update before it left no trace
    assert sorted(r["seq"] for r in rejected.collect()) == [2, 5]


LOG = "seq bigint, domain string, last_modified timestamp, modified_by string, tld string, ns_domains array<string>, visits_12m bigint"


def test_history(spark):
    at = [datetime(2024, 1, d, tzinfo=timezone.utc) for d in (1, 2, 3, 4)]
    log = spark.createDataFrame([(1, "a.com", at[0], "pi", "com", ["x"], 1), (2, "a.com", at[1], "pi", "com", ["x"], 1),
                                 (3, "a.com", at[2], "dns", "com", ["y"], None), (4, "a.com", at[3], "dns", "net", ["y"], None)], LOG)
    hist = history.change_history(log, ["tld", "ns_domains", "visits_12m"])
    got = {r["seq"]: {c["field"]: (c["before"], c["after"]) for c in r["changes"]} for r in hist.collect()}
    assert set(got) == {1, 3, 4}  # nothing changed in version 2
    assert got[3] == {"ns_domains": ('["x"]', '["y"]'), "visits_12m": ("1", None)} and got[4] == {"tld": ("com", "net")}
    table = [tuple(r)[1:] for r in history.change_table(log, ["tld", "ns_domains", "visits_12m"]).orderBy("seq", "field")
             .select("domain", "seq", "modified_by", "field", "before", "after").collect()]
    assert (1, "pi", "ns_domains", "N/A", '["x"]') in table and (3, "dns", "visits_12m", "1", None) in table
    assert not [t for t in table if t[0] == 3 and t[2] == "ns_domains"]  # shown for the first version only
    shown = history.domain_changes(log, "a.com", ["tld", "visits_12m"]).collect()
    assert [r["seq"] for r in shown] == sorted([r["seq"] for r in shown], reverse=True)


ZONE = "domain string, ns array<string>"


def test_diff(spark):
    prev = spark.createDataFrame([("gone.com", ["a"]), ("same.com", ["a", "b"]), ("moved.com", ["a"])], ZONE)
    cur = spark.createDataFrame([("same.com", ["a", "b"]), ("moved.com", ["b"]), ("new.com", ["c"])], ZONE)
    got = {r["domain"]: r["ns"] for r in snapshots.diff_snapshots(prev, cur).collect()}
    assert got == {"gone.com": [], "moved.com": ["b"], "new.com": ["c"]}
    assert snapshots.diff_snapshots(cur, cur).count() == 0
    applied = {r["domain"]: r["ns"] for r in prev.collect()}
    applied.update(got)
    assert {d: v for d, v in applied.items() if v} == {r["domain"]: r["ns"] for r in cur.collect()}
    assert [r[0] for r in snapshots.removed_keys(prev, cur).collect()] == ["gone.com"]
    assert snapshots.change_count(prev, cur).first()["changes"] == 3


@pytest.mark.parametrize("name", list(schema.UPDATE_TYPES))
def test_update_types_fit_the_table(name):
    assert set(schema.UPDATE_TYPES[name].columns) <= set(schema.TABLE_COLS)


def test_schema():
    assert len(schema.ALL_COLS) == 45


def test_updates_are_made_once_and_stored_without_repeats(spark, monkeypatch):
    """Whatever makes the updates runs once per row, however often they are read; the fold stores no column beside its cell."""
    from zonewright.operators import skew
    ups = spark.createDataFrame([(i, f"d{i % 5}.{'zz' if i % 2 else 'com'}") for i in range(20)], "seq bigint, domain string")
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def kind(_):
        made.add(1)
        return "PIResult"

    raw = ups.withColumn("type", kind.asNondeterministic()("domain")).withColumn("visits", F.col("seq"))
    updates = merge.as_updates(raw.withColumnRenamed("visits", "visits_12m"), F.col("seq"), F.lit("2024-03-05").cast("timestamp"))
    stored = []
    inner = skew.in_blocks
    monkeypatch.setattr(skew, "in_blocks", lambda df, *a, **k: (stored.append(df.columns), inner(df, *a, **k))[1])
    rows, rejected = merge.apply_updates(updates.select(*schema.TABLE_COLS).limit(0), updates, Suffixes.of(spark, ["com"]))
    assert {r["seq"] for r in rows.select("seq").collect()} == {i for i in range(20) if not i % 2}
    assert made.value == 20
    assert not [c for c in stored[0] if c.startswith("_cell") or c == "visits_12m"]
    assert rejected.count() == 10
