"""Raw DNS answers to one typed update per domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.operators.names import Suffixes, normalize
from zonewright.operators.skew import sorted_lists


def normalise_dns(answers: DataFrame, suffixes: Suffixes) -> DataFrame:
    """Answers `(domain, rrtype, section, rdata, rcode)` to DNS updates, one per domain.

    Addresses, mail hosts and texts come from the answer section, servers from the authority
    section; host names lose their trailing dot, lists are sorted and keep repeats. The reply code
    is that of the address query.
    """
    kind = F.upper("rrtype")
    answer = F.upper("section") == "ANSWER"
    flags = {"addr": answer & (kind == "A"), "mx": answer & (kind == "MX"), "txt": answer & (kind == "TXT"),
             "ns": (F.upper("section") == "AUTHORITY") & (kind == "NS")}
    is_ns = flags["ns"]
    rdata = F.when(kind.isin("MX", "NS"), F.lower(F.rtrim(F.col("rdata"), F.lit(".")))).otherwise(F.col("rdata"))
    clean = answers.select(F.lower("domain").alias("domain"), "rrtype", "section", rdata.alias("rdata"), "rcode")
    # server names are normalised where they stand, before anything is gathered
    named = normalize(clean.withColumn("_host", F.when(is_ns, F.col("rdata"))), "_host", suffixes, "_name")
    lists = sorted_lists(
        named, ["domain"], "rdata", flags, with_value=["_name"], greatest={"rcode": F.when(kind == "A", F.col("rcode"))},
        more=[F.array_sort(F.collect_set(F.when(F.col("_is_ns"), F.col("_name")))).alias("ns_domains")])
    return lists.select("domain", F.lit("DNSResult").alias("type"), F.lit("dns").alias("modified_by"), "addr", "ns", "mx",
                        "txt", "ns_domains", (F.size("ns") > 0).alias("dns_exists"), F.coalesce("rcode", F.lit("")).alias("rcode"))
