"""Files on disk, imports, dimensions, selection, reports."""

import gzip
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from zonewright.operators import dims, latest, reports, selection
from zonewright.operators.names import Suffixes
from zonewright.plans import jobs
from zonewright.sources import messages, tables, zone

Z1 = """com. 900 in soa a.example. b.example. 1 2 3 4 5
alpha.com. 172800 in ns ns2.dns.net.
alpha.com. 172800 in ns ns1.dns.net.
alpha.com. 172800 in rrsig ns 8 2 172800 xyz

beta.com. 172800 in ns ns1.beta.com.
beta.com. 172800 in a 192.0.2.1
short line
gamma.com. 172800 in ns ns1.dns.net.
"""
Z2 = """com. 900 in soa a.example. b.example. 1 2 3 4 5
alpha.com. 172800 in ns ns1.dns.net.
alpha.com. 172800 in ns ns2.dns.net.
gamma.com. 172800 in ns ns9.dns.net.
delta.com. 172800 in ns ns1.dns.net.
"""
Z3 = "EPSILON NS NS1.DNS.NET.\nEPSILON NS NS1.OWN\nZETA NS NS1\nEPSILON NS NS1.OWN\nX NS RRSIG\n"


@pytest.fixture
def folder(tmp_path):
    for name, text in [("zone-com-2024-03-01.gz", Z1), ("zone-com-2024-03-04.gz", Z2), ("zone-net-2024-03-04.gz", Z3), ("notes.txt", "x")]:
        if name.endswith(".gz"):
            with gzip.open(tmp_path / name, "wt") as f:
                f.write(text)
        else:
            (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_read_zone(spark, folder):
    recs = zone.read_zone(spark, f"{folder}/zone-com-2024-03-01.gz")
    from zonewright.operators.snapshots import zone_snapshot
    snap = {r["domain"]: r["ns"] for r in zone_snapshot(recs).collect()}
    assert snap == {"alpha.com": ["ns1.dns.net", "ns2.dns.net"], "beta.com": ["ns1.beta.com"], "gamma.com": ["ns1.dns.net"]}
    rel = {r["domain"]: r["ns"] for r in zone_snapshot(zone.read_zone(spark, f"{folder}/zone-net-2024-03-04.gz", "net")).collect()}
    assert rel == {"epsilon.net": ["ns1.dns.net", "ns1.own.net", "ns1.own.net"], "zeta.net": ["ns1.net"]}


def test_import_zones(spark, folder):
    s = Suffixes.of(spark, ["com", "net"])
    ledger = spark.createDataFrame([("com", date(2024, 3, 1))], "tld string, date date")
    updates, done = jobs.import_zones(spark, folder, ledger, s)
    got = {(r["tld"], r["domain"]): r for r in updates.collect()}
    assert {k[1]: v["ns"] for k, v in got.items() if k[0] == "com"} == {"beta.com": [], "gamma.com": ["ns9.dns.net"], "delta.com": ["ns1.dns.net"]}
    assert got[("com", "gamma.com")]["ns_domains"] == ["dns.net"] and got[("com", "beta.com")]["ns_domains"] == []
    assert got[("com", "gamma.com")]["last_modified"] == datetime(2024, 3, 4) and got[("com", "gamma.com")]["zonefile_date"] == date(2024, 3, 4)
    assert got[("net", "zeta.net")]["ns"] == ["ns1.net"]  # no earlier file: all rows
    assert {tuple(r) for r in done.collect()} == {("com", date(2024, 3, 4)), ("net", date(2024, 3, 4))}
    zone.record_import(done, f"{folder}/ledger")
    again = jobs.import_zones(spark, folder, spark.read.parquet(f"{folder}/ledger"), s)
    assert again[0].count() == 0 and again[1].count() == 0
    full = jobs.import_zones(spark, folder, ledger, s, full=True, tlds=["com"])[0]
    assert {r["domain"] for r in full.collect()} == {"alpha.com", "gamma.com", "delta.com"}


def test_file_listing(spark, folder):
    files, others = zone.list_zone_files(spark, folder)
    assert {(r["tld"], str(r["date"])) for r in files.collect()} == {("com", "2024-03-01"), ("com", "2024-03-04"), ("net", "2024-03-04")}
    assert others.count() == 1
    prev = {(r["tld"], str(r["date"])): r["prev_date"] for r in zone.previous_zone_file(files).collect()}
    assert prev == {("com", "2024-03-01"): None, ("com", "2024-03-04"): date(2024, 3, 1), ("net", "2024-03-04"): None}


def test_name_lists(spark, tmp_path):
    (tmp_path / "l.txt").write_text(" Shop.COM \nwww.other.com\nnothing\n")
    listed = tables.read_domain_list(spark, str(tmp_path / "l.txt"))
    up, counts = tables.import_names(listed, Suffixes.of(spark, ["com"]))
    assert sorted(r["domain"] for r in up.collect()) == ["other.com", "shop.com"] and tuple(counts.first()) == (2, 1)
    have = spark.createDataFrame([("shop.com", 1), ("x.com", 2)], "domain string, v int")
    assert [r["domain"] for r in dims.bulk_lookup(have, listed).collect()] == ["shop.com"]
    assert sorted(r["domain"] for r in dims.missing_names(listed, have).collect()) == ["nothing", "www.other.com"]


def test_registrars(spark, tmp_path):
    (tmp_path / "au.csv").write_text("registrar_name,registrar_id\nSouth NAMES,1\nOnly AU,2\n")
    (tmp_path / "main.csv").write_text("id,registrar_name\n1,South Names\n3,Old\n3,New\n")
    au, main = tables.read_registrars(spark, str(tmp_path / "au.csv"), str(tmp_path / "main.csv"))
    union = dims.union_registrars(au, main)
    assert {tuple(r) for r in union.collect()} == {(1, "South Names"), (2, "only au"), (3, "New")}
    ids = {r["registrar_name"]: r["registrar_id"] for r in dims.registrar_names(main, au).collect()}
    assert ids == {"South NAMES": 1, "Only AU": 2, "South Names": 1, "Old": 3, "New": 3}
    old = spark.createDataFrame([(1, "South Names"), (2, "other"), (9, "kept")], "registrar_id bigint, registrar_name string")
    rows = spark.createDataFrame([("a.com", 2, "other"), ("b.com", 1, None), ("c.com", None, "x")], "domain string, registrar_id bigint, registrar_name string")
    merged, done = jobs.refresh_registrars(old, au, main, rows)
    assert {tuple(r) for r in merged.collect()} == {(1, "South Names"), (2, "only au"), (3, "New"), (9, "kept")}
    assert {r["domain"]: r["registrar_name"] for r in done.collect()} == {"a.com": "only au", "b.com": None, "c.com": "x"}
    _, changed = dims.upsert_dimension(old, union, "registrar_id", "registrar_name")
    assert {tuple(r) for r in changed.collect()} == {(2, "only au"), (3, "New")}


def test_registry(spark):
    d = spark.createDataFrame([(1, "a.com", "Not Available"), (2, "b.com", "available"), (3, "c.com", "pending"), (4, "d.com", "not available")],
                              "id bigint, domain string, whois_check_status string")
    i = spark.createDataFrame([(1, date(1984, 5, 5)), (2, date(2001, 2, 3))], "domain_id bigint, estimated_created_date date")
    got = {r["domain"]: tuple(r)[1:] for r in dims.registry_status(d, i).collect()}
    assert got == {"a.com": (True, None), "b.com": (False, datetime(2001, 2, 3)), "d.com": (False, None)}
    have = spark.createDataFrame([("a.com",)], "domain string")
    assert {r["domain"] for r in jobs.load_registry_status(have, d, i).collect()} == {"b.com", "d.com"}
    assert [r["key"] for r in tables.status_requests(d).collect()] == ["a.com"]


def test_traffic_files(spark, tmp_path):
    df = spark.createDataFrame([("a.com", 1, "2024-01-01", 2, "AU", [1, 2], 5, "extra"), ("www.a.com", 1, "2024-01-01", 2, "AU", [1], 5, "extra")],
                               "domain string, visits bigint, lastdate string, hits bigint, geo string, visits_arr array<int>, rank int, more string")
    df.write.parquet(str(tmp_path / "t" / "1year"))
    raw = tables.read_traffic(spark, str(tmp_path / "t" / "*"))
    assert "more" not in raw._jdf.queryExecution().executedPlan().toString()
    up = tables.traffic_updates(raw, Suffixes.of(spark, ["com"])).collect()
    assert len(up) == 1 and up[0]["visits_arr_12m"] == [1, 2] and up[0]["last_visit_date"] == date(2024, 1, 1)


def test_latest(spark):
    log = spark.createDataFrame([("a", 1, 10, "x"), ("a", 1, 11, "y"), ("a", 0, 99, "z"), ("b", 5, None, "q")],
                                "domain string, last_modified bigint, seq bigint, v string")
    got = {r["domain"]: r["v"] for r in latest.latest_by_key(log).collect()}
    assert got == {"a": "y", "b": "q"}
    assert {r["domain"]: r["v"] for r in latest.latest_by_key(log, order=("seq",)).where("domain = 'a'").collect()} == {"a": "z"}
    assert latest.total_rows(log).first()[0] == 2 and latest.point_lookup(log, "a").first()["v"] == "y"


def test_compaction(spark, tmp_path):
    log = spark.createDataFrame([(f"d{i % 7}.com", i, i) for i in range(50)], "domain string, last_modified bigint, seq bigint")
    latest.compact(log, str(tmp_path / "v1"), buckets=4)
    view = spark.read.parquet(str(tmp_path / "v1")).drop("bucket")
    assert sorted(map(tuple, view.select("domain", "seq").collect())) == sorted(map(tuple, latest.latest_by_key(log).select("domain", "seq").collect()))


def test_selection_and_routing(spark):
    s = Suffixes.of(spark, ["com", "us", "au", "com.au"])
    pairs = spark.createDataFrame([("A.com", "whois"), ("a.us", "whois"), ("a.com.au", "whois"), ("a.com", "dns"), ("a.us", "rdap"), ("zz", "whois"), ("a.com", "ftp")],
                                  "domain string, scraper string")
    good, bad = selection.route_requests(pairs, s)
    assert sorted((r["key"], r["topic"]) for r in good.collect()) == [
        ("a.com", "scrape.dns"), ("a.com", "scrape.rdap"), ("a.com.au", "scrape.whois"), ("a.us", "scrape.rdap"), ("a.us", "scrape.whois"), ("zz", "scrape.rdap")]
    assert [tuple(r) for r in bad.collect()] == [("a.com", "unknown scraper: ftp")]
    with pytest.raises(ValueError):
        selection.with_scrapers(pairs, ["ftp"])
    names = spark.createDataFrame([(f"d{i}.com",) for i in range(20)], "domain string")
    assert jobs.queue_scrapes(names, ["dns", "whois"], s, limit=5).count() == 10  # exactly five names
    one, two = (jobs.queue_scrapes(names, ["dns"], s, limit=5, shuffle=True).orderBy("key").collect() for _ in range(2))
    assert one == two
    with_tag = selection.preferred_scraper(spark.createDataFrame([("a.us",), ("a.com",)], "domain string"), s)
    assert {r["domain"]: r["scraper"] for r in with_tag.collect()} == {"a.us": "whois", "a.com": "rdap"}


def test_age_report_boundaries(spark):
    rows = [(None,), ("2024-04-10 00:00:00",), ("2024-05-10 00:00:00",), ("2024-07-01 00:00:00",), ("2024-01-01 00:00:00",)]
    df = spark.createDataFrame(rows, "t string").select(F.to_timestamp("t").alias("dns_scraped"), F.lit(None).cast("timestamp").alias("whois_scraped"))
    r = reports.scrape_age_report(df, "2024-07-09 00:00:00").first()
    # 2024-04-10 is 90 days back and 2024-05-10 60 days back: a boundary counts in both bands
    assert (r["dns_scraped_never"], r["dns_scraped_gt_90"], r["dns_scraped_60_90"], r["dns_scraped_30_60"], r["dns_scraped_30_7"], r["dns_scraped_lt_7"]) == (
        1, 1, 2, 1, 1, 0)
    assert r["whois_scraped_never"] == 5


def test_recent_errors_sample_keeps_pairs(spark):
    rows = [(f"u{i:02d}", f"d{i:02d}.com", "E", "f", 1, None, "t", f"2024-01-02 00:00:{59 - i:02d}") for i in range(25)]
    df = spark.createDataFrame(rows, "uuid string, domain string, error_type string, file string, line int, scraper string, topic string, ts string")
    df = df.withColumn("timestamp", F.to_timestamp("ts"))
    r = reports.recent_errors(df, "2024-01-03 00:00:00").collect()
    assert len(r) == 1 and r[0]["count"] == 25 and len(r[0]["uuids"]) == 10 and r[0]["uuids"][0] == "u24"
    assert [u[1:] for u in r[0]["uuids"]] == [d[1:3] for d in r[0]["domains"]]


def test_ns_report_ignores_self_only(spark):
    rows = [("free.com", False, ["free.com"]), ("a.com", True, ["big.com"]), ("b.com", True, ["big.com", "free.com"]), ("big.com", False, []), ("c.com", None, ["taken.com"]),
            ("d.com", None, ["taken.com"]), ("taken.com", True, []), ("solo.com", False, ["solo.com"])]
    df = spark.createDataFrame(rows, "domain string, registered boolean, ns_domains array<string>")
    assert sorted(map(tuple, reports.ns_domain_report(df).collect())) == [("big.com", 2), ("free.com", 2)]


def test_request_rate(spark):
    df = spark.createDataFrame([("x", f"2024-01-01 00:00:0{s}") for s in (0, 0, 0, 1, 3)], "target string, ts string").withColumn("ts", F.to_timestamp("ts"))
    got = [(r["cur_count"], r["prev_count"], r["load"], r["over_limit"]) for r in reports.request_rate(df, "target", "ts", 3, at=0.5).orderBy("window_start").collect()]
    assert got == [(3, 0, 3.0, False), (1, 3, 2.5, False), (1, 0, 1.0, False)]


def test_messages(spark):
    msgs = spark.createDataFrame([("scrape.rdap.srv_a", "a.com", "{}", 1, None), ("scrape.dns", "b.com", "{}", 2, None), ("other", "c.com", "{}", 3, None)], messages.MESSAGE)
    got = {r["key"]: (r["scraper"], r["shard"]) for r in messages.request_messages(msgs).collect()}
    assert got == {"a.com": ("rdap", "srv_a"), "b.com": ("dns", None)}
    err = '{"error":"e","error_type":"T","file":"f","line":3,"traceback":"tb","scraper":"dns","topic":"t","timestamp":"2024-01-01T00:00:00.5"}'
    emsgs = spark.createDataFrame([("errors", "A.com", err, 1, None), ("errors", "b.com", "nope", 2, None), ("errors", "b.com", "{}", 2, None)], messages.MESSAGE)
    rows, bad = messages.error_rows(emsgs)
    r = rows.first()
    assert r["domain"] == "a.com" and r["line"] == 3 and len(r["uuid"]) == 36 and bad.count() == 2
