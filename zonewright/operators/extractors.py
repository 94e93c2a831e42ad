"""Registry of extraction jobs, so that a new source plugs in by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Extractor = Callable[..., DataFrame]
_EXTRACTORS: dict[str, Extractor] = {}


def register_extractor(name: str, job: Extractor) -> None:
    """`job` turns a frame of raw captures (and named lookups) into a frame of typed updates."""
    if name in _EXTRACTORS:
        raise ValueError(f"extractor {name!r} exists")
    _EXTRACTORS[name] = job


def extractor(name: str) -> Extractor:
    try:
        return _EXTRACTORS[name]
    except KeyError:
        raise ValueError(f"unknown extractor {name!r}; known: {sorted(_EXTRACTORS)}") from None


def _builtin() -> None:
    from zonewright.operators.extract_dns import normalise_dns
    from zonewright.operators.extract_rdap import extract_rdap
    from zonewright.operators.extract_whois import extract_whois

    def whois(raw: DataFrame, registrar_ids: DataFrame) -> DataFrame:
        records, nx, _ = extract_whois(raw, registrar_ids)
        return records.unionByName(nx, allowMissingColumns=True)

    def rdap(raw: DataFrame) -> DataFrame:
        parts = extract_rdap(raw)
        return parts["records"].unionByName(parts["nx"], allowMissingColumns=True)

    register_extractor("dns", normalise_dns)
    register_extractor("whois", whois)
    register_extractor("rdap", rdap)


_builtin()
