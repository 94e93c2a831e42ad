"""Captured responses with invented people and names."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from zonewright.functions import text
from zonewright.operators import enrich, extract_dns, extract_rdap, extract_whois
from zonewright.operators.extractors import extractor, register_extractor
from zonewright.operators.names import Suffixes
from zonewright.sources import tables

W_US = """Domain Name: orchard.us\r
Registrar: Example Registrar LLC\r
Registrar IANA ID: 4711\r
Updated Date: 2023-03-04T05:06:07Z\r
Creation Date: 2019-02-11T08:09:10Z\r
Registry Expiry Date: 2026-02-11T08:09:10Z\r
Domain Status: clientTransferProhibited https://icann.example/epp#clientTransferProhibited\r
Registrant Name: Robin Maple\r
Registrant Organization:\r
Registrant Country: US\r
Admin Name: Kim Birch\r
Admin Email: kim@orchard.example\r
Tech Phone: +1.5550100\r
>>> Last update of database\r
"""
W_AU = """Domain Name: hillside.com.au
Last Modified: 2024-01-09T01:02:03Z
Registrar Name: Southern Names Pty
Status: serverRenewProhibited
Status Reason: Renewal on hold
Registrant Contact Name: Alex Fern
Registrant: FERN, ALEX
Registrant ID: ABN 00000000000
Eligibility Type: Company
Eligibility Name: Hillside Trust
Eligibility ID: ABN 11111111111
"""
W_REPEAT = """Updated Date: 2020-01-01
   Updated Date:   2021-02-03 04:05:06
Registrar: First
Registrar: Southern Names Pty
Status: b x
Domain Status: a y
Status: b z
not at start Status: c
"""


def _whois(spark, **texts):
    raw = spark.createDataFrame([(k.replace("_", "."), v) for k, v in texts.items()], "domain string, whois_text string")
    ids = spark.createDataFrame([("Southern Names Pty", 8123)], "registrar_name string, registrar_id bigint")
    rec, nx, bad = extract_whois.extract_whois(raw, ids)
    return ({r["domain"]: r for r in rec.collect()}, [r["domain"] for r in nx.collect()], {r["domain"]: r["reason"] for r in bad.collect()})


def test_whois(spark):
    base = "Updated Date: 2020-01-01\nRegistrar: {}\nStatus: ok\n"
    rec, nx, bad = _whois(spark, us=W_US, au=W_AU, rep=W_REPEAT, free="No match for \"FREE.US\".", res="foo is free",
                          low="no match for x\nUpdated Date: 2020-01-01", unknown=base.format("Nobody"),
                          date=base.format("Southern Names Pty").replace("2020-01-01", "01.02.2020"),
                          ident=base.format("Southern Names Pty") + "Registrar IANA ID: n/a\n")
    us = rec["us"]
    assert us["registered"] and us["registrar_id"] == 4711 and us["status"] == ["clientTransferProhibited"]
    assert us["registration_date"] == datetime(2019, 2, 11, 8, 9, 10) and us["expiration_date"] == datetime(2026, 2, 11, 8, 9, 10)
    assert us["last_changed_date"] == datetime(2023, 3, 4, 5, 6, 7)
    assert (us["registrant_name"], us["registrant_organization"], us["registrant_country"]) == ("Robin Maple", None, "US")
    assert (us["admin_name"], us["admin_email"], us["tech_phone"]) == ("Kim Birch", "kim@orchard.example", "+1.5550100")
    au = rec["au"]
    assert au["registrar_id"] == 8123 and au["status"] == ["serverRenewProhibited"] and au["registrant_name"] == "Alex Fern"
    assert (au["registrant"], au["registrant_id"], au["eligibility_type"], au["eligibility_name"], au["eligibility_id"]) == (
        "FERN, ALEX", "ABN 00000000000", "Company", "Hillside Trust", "ABN 11111111111")
    assert rec["rep"]["last_changed_date"] == datetime(2021, 2, 3, 4, 5, 6) and rec["rep"]["status"] == ["b", "a", "b"]
    assert rec["rep"]["registrar_name"] == "Southern Names Pty"
    assert sorted(nx) == ["free", "res"]
    assert bad == {"low": "missing registrar_name; missing registrar_id; missing status", "unknown": "unknown registrar",
                   "date": "bad last_changed_date", "ident": "bad registrar_id"}


def _card(**p):
    out = [["version", {}, "text", "4.0"]]
    for k, v in p.items():
        out.append([k, {"type": "voice"} if k == "tel" else {}, "uri" if k == "tel" else "text", v])
    return ["vcard", out]


EVENTS = [{"eventAction": "registration", "eventDate": "2006-08-18T02:05:16.65Z"}, {"eventAction": "expiration", "eventDate": "2030-08-18T02:05:16Z"},
          {"eventAction": "registration", "eventDate": "1999-01-01T00:00:00Z"}]
IANA = [{"type": "IANA Registrar ID", "identifier": "292"}]


def _rdap(spark, **docs):
    rows = [(k, d if isinstance(d, int) else 200, None if isinstance(d, int) else json.dumps(d)) for k, d in docs.items()]
    parts = extract_rdap.extract_rdap(spark.createDataFrame(rows, "domain string, status_code int, rdap_json string"))
    return {n: {r["domain"]: r for r in f.collect()} for n, f in parts.items()}


def test_rdap(spark):
    adr = ["", "", "1 Long Lane", "Town", "VIC", "3000", ""]
    plain = {"events": EVENTS, "status": ["active"], "entities": [{"roles": ["registrar"], "publicIds": IANA}]}
    out = _rdap(
        spark, plain=plain,
        top={**plain, "publicIds": [{"type": "IANA Registrar ID", "identifier": "7"}], "status": "active"},
        case={"events": [{"eventAction": "registration", "eventDate": "2010-01-02 03:04:05"}],
              "entities": [{"roles": ["registrar"], "publicIDs": [{"type": "x", "Identifier": "1"}, {"type": "IANA Registrar ID", "Identifier": "55"}]}]},
        soft={"events": [EVENTS[0], {"eventAction": "soft expiration", "eventDate": "2031-01-01T00:00:00Z"}], "entities": []},
        people={**plain, "entities": [
            {"handle": "A-1", "roles": ["registrant"], "vcardArray": _card(fn="Sam Oak", org="Oak Ltd", tel="tel:+1.555", email="s@oak.example", adr=adr)},
            {"handle": "x.info", "roles": ["administrative"], "vcardArray": _card(fn="Jo Elm", tel="tel:+1.777")},
            {"roles": ["technical", "abuse"], "vcardArray": _card(fn="First", email="f@x.example", adr=[*adr[:6], "AU"])},
            {"roles": ["technical"], "vcardArray": _card(fn="Second", adr="one line")}, {"roles": ["registrant"]}]},
        gone=404, slow=429, deny=403, busy=422, dead=500, notjson={"a": 1}, noreg={"events": [], "entities": []})
    rec = out["records"]
    assert set(rec) == {"plain", "top", "case", "soft", "people"}
    assert rec["plain"]["registrar_id"] == 292 and rec["plain"]["transfer_date"] is None and rec["plain"]["status"] == ["active"]
    assert rec["plain"]["registration_date"] == datetime(2006, 8, 18, 2, 5, 16, 650000)
    assert rec["plain"]["registrant_name"] is None and rec["plain"]["registrant_adr"] == []
    assert rec["top"]["registrar_id"] == 7 and rec["top"]["status"] == ["active"]
    assert rec["case"]["registrar_id"] == 55 and rec["case"]["status"] == [] and rec["case"]["last_changed_date"] is None
    assert rec["soft"]["expiration_date"] == datetime(2031, 1, 1) and rec["soft"]["registrar_id"] is None
    p = rec["people"]
    assert (p["registrant_name"], p["registrant_organization"], p["registrant_phone"], p["registrant_email"]) == (
        "Sam Oak", "Oak Ltd", "tel:+1.555", "s@oak.example")
    assert p["registrant_stateprovince"] == "VIC" and p["registrant_country"] is None and json.loads(p["registrant_adr"][0]) == adr
    assert p["admin_name"] == "Jo Elm" and json.loads(p["admin_phone"]) == {"type": "voice"}  # .info handles: second element
    assert p["tech_name"] == "Second" and p["tech_email"] == "f@x.example" and p["tech_country"] == "AU" and p["tech_adr"] == ["one line"]
    assert set(out["nx"]) == {"gone"} and set(out["throttled"]) == {"slow", "deny", "busy"} and set(out["failed"]) == {"dead"}
    assert {d: r["reason"] for d, r in out["rejected"].items()} == {"notjson": "not an RDAP domain object", "noreg": "missing registration_date"}


def test_retry(spark):
    t = spark.createDataFrame([("a.com", 1), ("b.com", 5)], "domain string, attempt int")
    assert {(r["key"], r["attempt"]) for r in extract_rdap.retry_requests(t, 5).collect()} == {("a.com", 2)}


def test_dns(spark):
    rows = [("A.com", "A", "ANSWER", "192.0.2.9", "NOERROR"), ("A.com", "A", "ANSWER", "192.0.2.10", "NOERROR"),
            ("A.com", "NS", "AUTHORITY", "NS2.X.com.", "NOERROR"), ("A.com", "NS", "AUTHORITY", "ns1.x.com.", "NOERROR"),
            ("A.com", "NS", "ANSWER", "other.", "NOERROR"), ("A.com", "MX", "ANSWER", "mx.x.com.", "NOERROR"), ("A.com", "TXT", "ANSWER", "V=x.", "NOERROR"),
            ("b.com", "A", "ANSWER", None, "NXDOMAIN"), ("c.com", "NS", "AUTHORITY", "ns.unknown.zz.", "NOERROR")]
    df = spark.createDataFrame(rows, "domain string, rrtype string, section string, rdata string, rcode string")
    got = {r["domain"]: r for r in extract_dns.normalise_dns(df, Suffixes.of(spark, ["com"])).collect()}
    a = got["a.com"]
    assert a["addr"] == ["192.0.2.10", "192.0.2.9"] and a["ns"] == ["ns1.x.com", "ns2.x.com"] and a["ns_domains"] == ["x.com"]
    assert a["mx"] == ["mx.x.com"] and a["txt"] == ["V=x."] and a["dns_exists"] and a["rcode"] == "NOERROR"
    assert not got["b.com"]["dns_exists"] and got["b.com"]["addr"] == [] and got["b.com"]["rcode"] == "NXDOMAIN"
    assert got["c.com"]["dns_exists"] and got["c.com"]["ns_domains"] == []


def test_geo_and_asn(spark):
    geo = spark.createDataFrame([("192.0.2.0", 24, "PH"), ("192.0.2.128", 25, "US"), ("198.51.100.0", 24, "AU"), ("0.0.0.0", 1, "ZZ")],
                                "network string, prefix_len int, country_code string")
    asn = spark.createDataFrame([("192.0.2.0", 24, 15169), ("198.51.100.7", 32, 134788)], "network string, prefix_len int, asn bigint")
    rows = [("a.com", ["192.0.2.1", "192.0.2.200", "198.51.100.7", "198.51.100.7"]), ("b.com", ["203.0.113.9", "10.0.0.0"]), ("c.com", ["x", "300.1.1.1", "2001:db8::1"])]
    df = spark.createDataFrame(rows, "domain string, addr array<string>")
    got = {r["domain"]: (r["geo"], r["asn"]) for r in enrich.lookup_lists(
        df, ["domain"], {"geo": (geo, "country_code"), "asn": (asn, "asn")}).collect()}
    assert got == {"a.com": (["AU", "PH", "US"], ["134788", "15169"]), "b.com": (["ZZ"], []), "c.com": ([], [])}


def test_enrichment_leaves_other_updates_alone(spark):
    net = spark.createDataFrame([("192.0.2.0", 24, "PH")], "network string, prefix_len int, v string")
    df = spark.createDataFrame([(1, "a.com", "dns", ["192.0.2.1"], None, None, ["addr"]), (2, "a.com", "dns", [], ["old"], None, ["addr"]),
                                (3, "a.com", "pi", ["192.0.2.1"], None, None, ["addr"])],
                               "seq bigint, domain string, modified_by string, addr array<string>, geo array<string>, asn array<string>, fields array<string>")
    out = enrich.add_geo_asn(df, net.withColumnRenamed("v", "country_code"), net.withColumnRenamed("v", "asn"))
    got = {r["seq"]: (r["geo"], "geo" in r["fields"]) for r in out.collect()}
    assert got == {1: (["PH"], True), 2: (["old"], False), 3: (None, False)}


def test_extractor_registry(spark):
    register_extractor("upper", lambda raw: raw.select(F.upper("domain").alias("domain")))
    assert extractor("upper")(spark.createDataFrame([("a",)], "domain string")).first()[0] == "A"
    for bad in (lambda: extractor("nosuch"), lambda: register_extractor("dns", None)):
        try:
            bad()
            raise AssertionError("no error")
        except ValueError:
            pass
    raw = spark.createDataFrame([("a.com", 404, None)], "domain string, status_code int, rdap_json string")
    assert extractor("rdap")(raw).first()["type"] == "RDAPNXResult"


def test_extracted_rows_end_in_merged_rows(spark):
    from datetime import datetime
    from zonewright import schema
    from zonewright.operators import merge
    s, at = Suffixes.of(spark, ["us", "com.au", "com"]), datetime(2024, 5, 6, 7, 8, 9)
    ids = spark.createDataFrame([("Southern Names Pty", 77)], "registrar_name string, registrar_id bigint")
    texts = spark.createDataFrame([("Orchard.US", W_US), ("hillside.com.au", W_AU), ("free.us", "No Data Found")],
                                  "domain string, whois_text string")
    dns = spark.createDataFrame([("orchard.us", "A", "ANSWER", "10.0.0.1", "NOERROR"), ("orchard.us", "NS", "AUTHORITY", "NS1.Host.com.", "NOERROR")],
                                "domain string, rrtype string, section string, rdata string, rcode string")
    rdap = spark.createDataFrame([("gone.com", 404, None)], "domain string, status_code int, rdap_json string")
    arrived = F.lit(at)
    parts = [merge.as_updates(extractor("whois")(texts, ids), F.lit(1), arrived),
             merge.as_updates(extractor("dns")(dns, s), F.lit(2), arrived),
             merge.as_updates(extractor("rdap")(rdap), F.lit(3), arrived)]
    updates = parts[0].unionByName(parts[1]).unionByName(parts[2])
    back, bad = merge.decode_updates(merge.encode_updates(updates).select(F.lit(1).cast("bigint").alias("seq"), "key", "value", arrived.alias("arrived")))
    assert bad.count() == 0 and back.count() == updates.count()
    empty = spark.createDataFrame([], schema.table_schema())
    rows, rejected = merge.apply_updates(empty, updates, s)
    got = {(r["domain"], r["seq"]): r for r in rows.collect()}
    assert rejected.count() == 0 and got[("gone.com", 3)]["registered"] is False and got[("gone.com", 3)]["rdap_scraped"] == at
    last = got[("orchard.us", 2)]
    assert (last["registrar_id"], last["registered"], last["tld"], last["addr"], last["ns"]) == (4711, True, "us", ["10.0.0.1"], ["ns1.host.com"])
    assert last["whois_scraped"] == at and last["dns_scraped"] == at and last["rdap_scraped"] is None and last["modified_by"] == "dns"
    for odd in ("Nothing", None):
        try:
            merge.as_updates(dns.select("domain", F.lit(odd).cast("string").alias("type")), F.lit(1), arrived).collect()
            raise AssertionError("no error")
        except Exception as e:
            assert "unknown update type" in str(e)


def test_text_functions(spark):
    def one(col, value=None):
        return spark.createDataFrame([(value,)], "v string").select(col.alias("x")).first()["x"]

    v = F.col("v")
    for raw, shown in [("2031-07-04T05:06:07Z", "2031-07-04 05:06:07+0000"), ("2031-07-04T22:10:09-0300", "2031-07-04 22:10:09-0300"),
                       ("2031-07-04T22:10:09+0530", "2031-07-04 22:10:09+0530"), ("2030-11-09", "2030-11-09 00:00:00+0000"),
                       ("2030-11-09T08:09:10", "2030-11-09 08:09:10+0000"), ("09.11.2030", "2030-11-09 00:00:00+0000"),
                       ("2030. 11. 09.", "2030-11-09 00:00:00+0000"), ("soon", "")]:
        assert one(text.render_timestamp(v), raw) == shown
    assert one(text.url_short_name(v), "https://rdap.example.com/com/v1/") == "rdap_example_com_com_v1"
    assert one(text.url_short_name(v), "https://tld-rdap.example:8080/") == "tld-rdap_example_8080"
    assert one(text.number_label(v.cast("bigint")), "1234567") == "1.23M" and one(text.number_label(v.cast("bigint")), "2500000000") == "2.50B"
    assert one(text.number_label(v.cast("bigint")), "1000000") == "1,000,000" and one(text.number_label(v.cast("bigint"))) is None
    assert [one(text.age_label(F.lit(s))) for s in (200000, 7300, 61, 59)] == ["2 days ago", "2 hours ago", "1 minutes ago", "59 seconds ago"]
    assert one(text.short_text(v), "word " * 11) == "word " * 11  # 55 characters are left whole
    assert one(text.short_text(v), "word " * 12) == ("word " * 9).strip() + "..."
    assert one(text.referral_server(v), "x\nregistrar whois server:  whois.example\n") == "whois.example"
    assert one(text.referral_server(v), "nothing") is None
    assert [one(text.iso_timestamp(v), s) is None for s in ("2020-01-01", "2020-01-01 01:02:03", "01.01.2020", "2020")] == [False, False, True, True]
    assert one(text.plausible_registration(v.cast("date")), "1984-12-31") is None


def test_bootstrap_and_shards(spark, tmp_path):
    from zonewright.operators import dims
    path = tmp_path / "dns.json"
    path.write_text(json.dumps({"services": [[["com", "net"], ["https://rdap.example.com/v1/", "http://b/"]], [["org"], ["https://rdap.example.org/"]]]}))
    boot = tables.read_rdap_bootstrap(spark, str(path))
    assert sorted(map(tuple, boot.collect()))[0] == ("com", "https://rdap.example.com/v1/")
    df = spark.createDataFrame([("a.com",), ("b.org",), ("c.uk",), ("zz",)], "domain string")
    got = {r["domain"]: r["shard"] for r in dims.shard_for_domain(df, boot, Suffixes.of(spark, ["com", "org", "uk"])).collect()}
    assert got == {"a.com": "rdap_example_com_v1", "b.org": "rdap_example_org", "c.uk": None, "zz": None}
    servers = tmp_path / "whois.json"
    servers.write_text(json.dumps([{"tld": "us", "whois_server": "whois.us.example"}, {"tld": "x"}, {"whois_server": "y"}]))
    assert [tuple(r) for r in tables.read_whois_servers(spark, str(servers)).collect()] == [("us", "whois.us.example")]
