"""Country and network-owner lookups for addresses."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.operators.once import once
from zonewright.operators.skew import salted_join

HOT = 10_000  # names with one address, from which on its rows are spread
_OCTET = r"(25[0-5]|2[0-4]\d|1?\d?\d)"
_IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def ip_number(ip: Column) -> Column:
    """IPv4 text as a number, NULL for anything else."""
    parts = F.split(ip, r"\.")
    number = sum(F.get(parts, i).try_cast("bigint") * (256 ** (3 - i)) for i in range(4))
    return F.when(ip.rlike(_IPV4), number)


def _masked(number: Column, bits: Column) -> Column:
    """Network part of an address: the number of its block of 2^(32-bits) addresses."""
    return F.floor(number / F.pow(F.lit(2.0), F.lit(32) - bits)).cast("bigint")


def longest_prefix(addresses: DataFrame, networks: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """`(addr, <out>...)`: per table the value of the most specific network that holds the address.

    `networks` is `{out: (table(network, prefix_len, ...), value column)}`, `addresses(addr)` must be
    distinct. Each address is looked up once per prefix length in use (at most 33), as an equi-join
    on (length, network number): no range condition and no pairs of rows that merely share a bucket.
    Addresses in no network are dropped.
    """
    lengths: set[int] = set()
    tables = []
    for out, (table, value) in networks.items():
        lengths |= {r["prefix_len"] for r in table.select("prefix_len").distinct().collect()}
        tables.append(table.select(
            F.lit(out).alias("_kind"), F.col("prefix_len").cast("int").alias("_bits"),
            _masked(ip_number(F.col("network")), F.col("prefix_len")).alias("_net"), F.col(value).cast("string").alias("_value")))
    known = (reduce(DataFrame.unionByName, tables).where(F.col("_net").isNotNull() & F.col("_value").isNotNull())
             .groupBy("_bits", "_net").agg(*[F.max(F.when(F.col("_kind") == out, F.col("_value"))).alias(out) for out in networks]))
    numbered = once(addresses.select("addr"), _n=ip_number(F.col("addr"))).where(F.col("_n").isNotNull())
    candidates = (numbered.select("addr", "_n", F.explode(F.array(*[F.lit(n) for n in sorted(lengths)])).alias("_bits"))
                  .select("addr", "_bits", _masked(F.col("_n"), F.col("_bits")).alias("_net")))
    return candidates.join(known, ["_bits", "_net"]).groupBy("addr").agg(*[
        F.max_by(out, F.when(F.col(out).isNotNull(), F.col("_bits"))).alias(out) for out in networks])


def lookup_lists(rows: DataFrame, key: Sequence[str], networks: dict[str, tuple[DataFrame, str]],
                 addr: str = "addr", find: Callable[..., DataFrame] = longest_prefix, hot: int = HOT) -> DataFrame:
    """Per key one sorted distinct list for each named network table; `find` looks up distinct addresses (`longest_prefix`, or
    `intervals.range_lookup` where there are many addresses).

    Addresses are made distinct first, as parking and delivery networks put one address on very
    many names; the answers go back to the rows by a join that is salted for the addresses on more than `hot` names,
    so that the answers for the many others are not repeated.
    """
    key = list(key)
    each = rows.select(*key, F.explode(addr).alias("addr"))
    often = each.groupBy("addr").agg(F.count(F.lit(1)).alias("_times")).where(F.col("_times") > hot).select("addr", F.lit(True).alias("_hot"))
    found = salted_join(each, find(each.select("addr").distinct(), networks), ["addr"], F.struct(*key), hot=often)
    return found.groupBy(*key).agg(*[F.array_sort(F.collect_set(out)).alias(out) for out in networks])


def add_geo_asn(updates: DataFrame, geo: DataFrame, asn: DataFrame) -> DataFrame:
    """Fill geo and asn of DNS updates that found addresses; all other updates leave them alone."""
    due = (F.col("modified_by") == "dns") & (F.size("addr") > 0)
    key = ["domain", "seq"]
    found = (lookup_lists(updates.where(due), key, {"_geo": (geo, "country_code"), "_asn": (asn, "asn")})
             .withColumn("_due", F.lit(True)))
    joined = updates.join(found, key, "left")
    hit = F.coalesce("_due", F.lit(False))
    return (joined.withColumn("geo", F.when(hit, F.col("_geo")).otherwise(F.col("geo")))
            .withColumn("asn", F.when(hit, F.col("_asn")).otherwise(F.col("asn")))
            .withColumn("fields", F.when(hit, F.array_union("fields", F.array(F.lit("geo"), F.lit("asn"))))
                        .otherwise(F.col("fields"))).drop("_geo", "_asn", "_due"))
