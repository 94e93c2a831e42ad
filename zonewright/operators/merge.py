"""Partial updates: decode and check them, fold them in arrival order, merge them into current rows.

An update row is `(seq, domain, type, fields, <columns>)`. `fields` names the columns the update
carries: a carried NULL overwrites, a column not in `fields` keeps its old value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright import schema
from zonewright.functions import text
from zonewright.operators import skew
from zonewright.operators.names import Suffixes, suffix_of
from zonewright.operators.once import once
from zonewright.session import compiled_wide

CURRENT_SEQ = -1  # orders the stored row before every update


# --- decoding -----------------------------------------------------------------------------------
def _typed(raw: Column, kind: str) -> Column:
    """Text of a JSON value to the column's type, NULL where it does not fit."""
    if kind == "string":
        return raw
    if kind.startswith("array"):
        return F.when(raw.startswith("["), F.from_json(raw, kind))
    if kind == "timestamp":
        return text.iso_timestamp(raw)
    if kind == "date":
        return text.iso_date(raw)
    return raw.try_cast(kind)


def _wire_names(column: str) -> list[str]:
    """Names under which any type sends this column."""
    names = {f.key for t in schema.UPDATE_TYPES.values() for f in t.fields if f.name == column}
    return sorted(names | {column})


_WIRES = sorted({w for c in schema.TABLE_COLS for w in _wire_names(c)} | {"type"})
_TYPED_COLS = [c for c, kind in schema.TABLE_TYPES.items() if kind != "string"]


def _reason(doc: Column, typed: Column, keys: Column, kind: Column, domain: Column) -> Column:
    """Why a message is no valid update of its type, '' for a valid one.

    `doc` has the JSON texts, `typed` their values, `keys` is the JSON as a map, which tells a NULL from an absent member.
    The rules of a type are written out as one expression, so that Spark compiles them; no function is called per rule.
    """
    def judge(key: str, name: str, required: bool, nullable: bool) -> Column:
        given, there = doc[key], F.map_contains_key(keys, F.lit(key))
        missing, null, bad = F.lit(f"missing {key}"), F.lit(f"null {key}"), F.lit(f"bad {key}")
        if required:
            out = F.when(given.isNull() & ~there, missing) if nullable else F.when(given.isNull(), F.when(there, null).otherwise(missing))
        else:
            out = F.when(given.isNull() & there, null) if not nullable else None
        if name in _TYPED_COLS:
            value = typed[name] if _wire_names(name) == [key] else _typed(given, schema.TABLE_TYPES[name])
            misfit = given.isNotNull() & value.isNull()
            out = F.when(misfit, bad) if out is None else F.coalesce(out, F.when(misfit, bad))
        return F.lit(None).cast("string") if out is None else out

    out = F.when(keys.isNull(), F.lit("not a JSON object"))
    nameless = F.when(F.coalesce(domain, F.lit("")) == "", F.lit("missing domain"))
    for name, spec in schema.UPDATE_TYPES.items():
        found = [judge(f.key, f.name, f.required, f.nullable) for f in spec.fields]
        found += [judge(s, s, False, True) for s in (*spec.stamps, "last_modified")]
        found.append(judge("modified_by", "modified_by", name == "Result", name != "Result"))
        out = out.when(kind == name, F.concat_ws("; ", *found, nameless))
    return out.otherwise("unknown type")


_LOWERED = {f.name for t in schema.UPDATE_TYPES.values() for f in t.fields if f.lower}


def _lowered(name: str, value: Column) -> Column:
    if name not in _LOWERED:
        return value
    return text.lower_all(value) if schema.TABLE_TYPES[name].startswith("array") else F.lower(value)


def _carried(kind: Column) -> Column:
    """Names of the columns that an update of a type overwrites, NULL for an unknown type."""
    pairs = [x for n, t in schema.UPDATE_TYPES.items() for x in (F.lit(n), F.array(*[F.lit(c) for c in t.columns]))]
    return F.try_element_at(F.create_map(*pairs), kind)


def _arrival_defaults(arrived: Column, kind: Column) -> dict[str, Column]:
    """Values of absent bookkeeping columns: the arrival time, and who makes updates of the type."""
    makers = [F.lit(x) for n, t in schema.UPDATE_TYPES.items() if t.modified_by for x in (n, t.modified_by)]
    return {"last_modified": arrived, "zonefile_date": F.to_date(arrived), "pi_import_date": F.to_date(arrived),
            "pm_added": arrived, **{s: arrived for t in schema.UPDATE_TYPES.values() for s in t.stamps},
            "modified_by": F.try_element_at(F.create_map(*makers), kind)}


def as_updates(extracted: DataFrame, seq: Column, arrived: Column, kind: str | None = None) -> DataFrame:
    """Rows of any extractor as whole-type updates for `encode_updates`, `merge_updates` and `apply_updates`.

    The type is `kind` or the rows' own `type`; an unknown one raises. `seq` orders the rows by arrival and must
    follow from the row alone; `arrived` fills the bookkeeping columns the rows lack or leave NULL. Other columns of
    the type that the rows lack become NULL, columns that are not in the table are left out.
    """
    tag = F.col("type") if kind is None else F.lit(kind)
    fields = F.coalesce(_carried(tag), F.raise_error(F.concat(F.lit("unknown update type "), F.coalesce(tag, F.lit("NULL")))))
    defaults = _arrival_defaults(arrived, tag)
    if "pm_blacklisted" not in extracted.columns:
        defaults["pm_blacklisted"] = arrived

    def value_of(c: str) -> Column:
        ddl = schema.TABLE_TYPES[c]
        value = _lowered(c, F.col(c).cast(ddl)) if c in extracted.columns else F.lit(None).cast(ddl)
        if c == "domain":
            return F.lower(value)
        if c in defaults:
            value = F.coalesce(value, F.when(F.array_contains(_carried(tag), c), defaults[c]).cast(ddl))
        return value

    return extracted.select(seq.cast("bigint").alias("seq"), tag.alias("type"), fields.alias("fields"),
                            *[value_of(c).alias(c) for c in schema.TABLE_COLS])


def decode_updates(messages: DataFrame, type_names: Mapping[str, str] | None = None,
                   parsed_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """JSON messages `(seq, key, value, arrived)` to (valid updates, quarantine).

    The message key is the domain unless it is NULL. `type_names` maps other spellings of the type
    tag to ours. With `parsed_only` an update carries only the columns present in its JSON; by
    default it carries every column of its type, so an absent optional one becomes NULL.
    """
    # a member that comes twice is an error or not as the session says for maps
    keys = F.map_from_entries(F.map_entries(F.from_json("value", "map<string,string>")))
    base = once(messages, _keys=keys)
    # the members that have a meaning are read by position: looking each of them up in the map would pass over all keys every time
    shape = ", ".join(f"`{w}` string" for w in _WIRES)
    base = once(base, _doc=F.when(F.col("_keys").isNotNull(), F.from_json("value", shape)))
    doc, typed = F.col("_doc"), F.col("_typed")
    kind = doc["type"]
    if type_names:
        renamed = F.create_map(*[F.lit(x) for pair in type_names.items() for x in pair])
        kind = F.coalesce(renamed[kind], kind)
    domain = F.lower(F.coalesce(F.col("key"), doc["domain"]))
    base = once(base, _type=kind, _domain=domain, _typed=F.struct(*[
        _typed(F.coalesce(*[doc[w] for w in _wire_names(c)]), schema.TABLE_TYPES[c]).alias(c) for c in _TYPED_COLS]))
    checked = once(base, _reason=_reason(doc, typed, F.col("_keys"), F.col("_type"), F.col("_domain")))
    quarantine = checked.where(F.col("_reason") != "").select("seq", "key", "value", F.col("_reason").alias("reason"))

    def value_of(name: str) -> Column:
        if name == "domain":
            return F.col("_domain")
        return _lowered(name, typed[name] if name in _TYPED_COLS else F.coalesce(*[doc[w] for w in _wire_names(name)]))

    defaults = _arrival_defaults(F.col("arrived"), F.col("_type"))
    defaults["pm_blacklisted"] = F.when(~F.map_contains_key("_keys", "pm_blacklisted"), F.col("arrived"))
    carried = _carried(F.col("_type"))
    if parsed_only:
        wires = F.create_map(*[x for c in schema.TABLE_COLS
                               for x in (F.lit(c), F.array(*[F.lit(w) for w in _wire_names(c)]))])
        always = F.array(*[F.lit(c) for c in defaults])
        carried = F.filter(carried, lambda c: F.array_contains(always, c) | F.exists(
            wires[c], lambda w: F.map_contains_key("_keys", w)))
    good = checked.where(F.col("_reason") == "")
    updates = good.select("seq", F.col("_type").alias("type"), carried.alias("fields"), *[
        F.coalesce(value_of(c), defaults[c]).alias(c) if c in defaults else value_of(c).alias(c)
        for c in schema.TABLE_COLS])
    return updates, quarantine


def encode_updates(updates: DataFrame) -> DataFrame:
    """Typed updates as messages `(key, value)`: lower-case domain, JSON of the carried columns only."""
    cols = [c for c in updates.columns if c in schema.TABLE_TYPES and c != "domain"]
    nulls = {"ignoreNullFields": "false"}

    def wire_name(c: str) -> Column:
        name = F.lit(c)
        for kind, spec in schema.UPDATE_TYPES.items():
            for f in spec.fields:
                if f.name == c and f.wire:
                    name = F.when(F.col("type") == kind, F.lit(f.wire)).otherwise(name)
        return name

    as_text = [F.when(F.array_contains("fields", c), F.struct(
        wire_name(c).alias("k"), F.to_json(F.struct(F.col(c).alias("v")), nulls).alias("v")))
        for c in cols]
    # each carried column is encoded alone and joined, so an explicit NULL stays visible as null
    pairs = F.transform(F.array_compact(F.array(*as_text)), lambda p: F.concat(
        F.lit('"'), p["k"], F.lit('":'), F.substring(p["v"], 6, F.length(p["v"]) - 6)))
    domain = F.lower("domain").alias("domain")
    head = F.to_json(F.struct("type", domain), nulls)
    part = F.concat(F.lit("{"), F.concat_ws(",", F.substring(head, 2, F.length(head) - 2), pairs), F.lit("}"))
    # an update of a whole type carries known columns, so it is encoded at once
    body = F.when(F.lit(False), part)
    for kind, spec in schema.UPDATE_TYPES.items():
        wires = {f.name: f.key for f in spec.fields}
        whole = F.to_json(F.struct("type", domain, *[F.col(c).alias(wires.get(c, c)) for c in cols if c in spec.columns]), nulls)
        body = body.when((F.col("type") == kind) & (F.col("fields") == F.array(*[F.lit(c) for c in spec.columns])), whole)
    body = body.otherwise(part)
    return updates.select(F.lower("domain").alias("key"), body.alias("value"))


# --- rules that rest on the update alone ---------------------------------------------------------
def registered_by_resolution(updates: DataFrame) -> DataFrame:
    """A name that resolves must be registered: DNS updates that found servers say so."""
    resolves = (F.col("modified_by") == "dns") & F.col("dns_exists")
    return (updates.withColumn("registered", F.when(resolves, F.lit(True)).otherwise(F.col("registered")))
            .withColumn("fields", F.when(resolves, F.array_union("fields", F.array(F.lit("registered"))))
                        .otherwise(F.col("fields"))))


def split_unknown_suffix(updates: DataFrame, current: DataFrame, suffixes: Suffixes) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected): rejected updates are of a name under no known suffix, before any row or
    update gave that name a suffix itself. Usable ones get `_suffix`."""
    with_suffix = suffix_of(updates, "domain", suffixes, "_suffix")
    odd = with_suffix.where(F.col("_suffix").isNull())
    gives = F.array_contains("fields", "tld") & (F.coalesce("tld", F.lit("")) != "")
    stored = (current.where(F.coalesce("tld", F.lit("")) != "").select("domain")
              .join(odd.select("domain").distinct(), "domain", "left_semi")
              .select("domain", F.lit(CURRENT_SEQ).cast("bigint").alias("seq")))
    first = (odd.where(gives).select("domain", "seq").unionByName(stored)
             .groupBy("domain").agg(F.min("seq").alias("_first")))
    judged = odd.join(first, "domain", "left")
    ok = F.coalesce(F.col("seq") >= F.col("_first"), F.lit(False))
    usable = with_suffix.where(F.col("_suffix").isNotNull()).unionByName(judged.where(ok).drop("_first"))
    rejected = judged.where(~ok).select("seq", F.col("domain").alias("key"), F.lit(None).cast("string").alias("value"),
                                        F.concat(F.lit("unknown suffix: "), F.col("domain")).alias("reason"))
    return usable, rejected


# --- fold ------------------------------------------------------------------------------------
def _fold(updates: DataFrame, groups: Sequence[Sequence[str]], key: str, order: Sequence[str],
          blocks: int | None) -> DataFrame:
    """Running fold of column groups: after each update `_g<i>` is the group's latest carried struct."""
    inside = {c for g in groups for c in g}
    kept = [c for c in updates.columns if c not in inside]
    cells = {f"_g{i}": F.when(F.array_contains("fields", g[0]), F.struct(*g)) for i, g in enumerate(groups)}
    # the cells hold the columns, so these are not carried beside them
    return skew.running_last(updates, [key], order, cells, blocks=blocks, keep=kept)


def fold_updates(updates: DataFrame, cols: Sequence[str], key: str = "domain", order: Sequence[str] = ("seq",),
                 blocks: int | None = None) -> DataFrame:
    """Running fold in arrival order: after each update, every column's latest carried value.

    Values come wrapped in a struct: NULL wrapper = never carried so far, wrapper with NULL = was
    set to NULL. The fold runs in ordered blocks, so a key with very many updates is folded in parallel.
    """
    folded = _fold(updates, [[c] for c in cols], key, order, blocks)
    wrapped = [F.when(F.col(f"_g{i}").isNotNull(), F.struct(F.col(f"_g{i}")[c].alias("c"))).alias(c)
               for i, c in enumerate(cols)]
    return folded.select(*[c for c in updates.columns if c not in cols], *wrapped)


def merge_updates(current: DataFrame, updates: DataFrame, cols: Sequence[str] | None = None,
                  together: Sequence[Sequence[str]] | None = None, blocks: int | None = None) -> DataFrame:
    """Every version that arises: one full row per update, oldest first per domain (`seq`).

    The stored row of each touched domain enters the fold as its first, all-carrying update, so
    rows, updates and defaults meet in one pass over one shuffle. Only touched stored rows take
    part: the big side is filtered by a semi join, not shuffled whole. `together` names columns
    that no update carries in part; they are folded as one.
    """
    cols = [c for c in (cols or schema.TABLE_COLS) if c != "domain"]
    groups = [list(g) for g in together] if together else [[c] for c in cols]
    touched = updates.select("domain").distinct()
    as_update = (current.join(touched, "domain", "left_semi")
                 .select(F.lit(CURRENT_SEQ).cast("bigint").alias("seq"), "domain",
                         F.array(*[F.lit(g[0]) for g in groups]).alias("fields"), *cols))
    extra = [c for c in updates.columns if c.startswith("_")]
    both = updates.select("seq", "domain", "fields", *cols, *extra).unionByName(as_update, allowMissingColumns=True)
    folded = _fold(both, groups, "domain", ["seq"], blocks).where(F.col("seq") != CURRENT_SEQ)
    out = {c: F.when(F.col(f"_g{i}").isNull(), schema.default_value(c)).otherwise(F.col(f"_g{i}")[c]).alias(c)
           for i, g in enumerate(groups) for c in g}
    return folded.select("seq", "domain", *[out[c] for c in cols], *extra)


def apply_updates(current: DataFrame, updates: DataFrame, suffixes: Suffixes,
                  enrich=None, whole_types: bool = True, blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The whole step: rules, enrichment, fold, suffix fill. Returns (new versions, rejected).

    `enrich` is an optional frame-to-frame step (such as address lookups) run on the updates. Say
    `whole_types=False` for updates that carry only part of their type's columns. The updates are read
    for the suffix rules, for the ranges of the fold and for the fold itself; they are kept for as long as that takes,
    so that whatever made them (extractors, decoding, lookups) runs once.
    """
    with compiled_wide(updates.sparkSession):
        ruled = registered_by_resolution(updates).persist()
        kept = [ruled]
        if enrich is not None:  # reads the updates for the look-up and for the way back
            ruled = enrich(ruled).persist()
            kept.append(ruled)
        usable, rejected = split_unknown_suffix(ruled, current, suffixes)
        together = schema.carried_together([c for c in schema.TABLE_COLS if c != "domain"]) if whole_types else None
        versions = merge_updates(current, usable, together=together, blocks=blocks)  # folded and stored when this returns
        for frame in kept:
            frame.unpersist()
    filled = versions.withColumn("tld", F.coalesce(F.when(F.col("tld") != "", F.col("tld")), F.col("_suffix")))
    return filled.drop("_suffix"), rejected
