"""PII surrogates: keyed replacements of the same type and format, as DataFrame expressions only."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, functions as F

from zonewright.llm import storage

STALLED = 8

# fixed values: forms of personal data and secrets, and forms of address by gender
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ADDRESS = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)"
SECRET = (r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}|(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])"
          r"|(?<=[=:\s\"'])(?<=(?:password|passwd|secret|token|api_key|apikey)\s{0,3}[=:]\s{0,3}[\"']{0,1})[^\s\"']{6,128}")
PHONE = (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
         r"|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])")
NUMBER = r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])|(?<![\w.-])\d(?:[ -]?\d){12,18}(?!\w)"
LABELS = ["password", "passwd", "secret", "token", "api_key", "apikey"]
MALE = "Mr|Mister|Herr|Monsieur|Señor|Don|Sir|Господин"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Señora|Doña|Lady|Госпожа"
NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
FORMS = "|".join(f"(?:{p})" for p in (EMAIL, SECRET, ADDRESS, PHONE, NUMBER))
ADDRESSED = rf"(?<!\p{{L}})(?:{MALE}|{FEMALE})\.? {NAME}(?: {NAME})?"
KEPT = r"^(?:AKIA|gh[pousr]_|sk-|\+\d{1,3}(?=[ .(-]))"
LATIN = "Ba Be Bo Da De Do Fa Fe Fi Ga Go Ha He Jo Ka Ke La Le Lo Ma Me Mi Mo Na Ne No Pa Pe Ra Ro Sa Se So Ta Te To Va Ve Wi Za".split()
CYRILLIC = "Ба Бе Бо Ва Ве Га Го Да До За Зо Ка Ко Ла Ле Ма Ме Ми На Но Па Пе Ра Ро Са Со Та То Фа Хо".split()
MIDDLE = {"l": "bel dan fer gar kel lin mar nor ral sen tor vin ber dor lan mer".split(), "c": "бел дан лин мар нор рал сен тор вин дор".split()}
END = {"lm": "o us er on".split(), "lf": "a ia ina elle".split(), "ln": "ton man berg ley".split(),
       "cm": "ан ор ий ус".split(), "cf": "а ия ина ара".split(), "cn": "ов ев ин".split(), "cw": "ова ева ина".split()}
NEUTRAL = ["ко"]


def _stream(key: Column, value: Column, salt: Column) -> Column:
    """Hex digits that follow from key, value and salt: two for each character of the value, and 128 or more beyond."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.length(value) / 32).cast("int") + 2),
                         lambda i: F.sha2(F.concat_ws("|", key, salt.cast("string"), i.cast("string"), value), 256))
    return F.array_join(blocks, "")


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), number % len(values) + 1)


def _like(value: Column, stream: Column) -> Column:
    """The value with each digit and letter changed for one of its kind; prefixes that tell the type stay."""
    head = F.regexp_extract(value, KEPT, 0)
    hexed = value.rlike("^[0-9a-f]{32,}$")

    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        return (F.when(i < F.length(head), c).when(c.rlike("[0-9]"), (b % 10).cast("string"))
                .when(hexed, F.substr(F.lit("abcdef"), b % 6 + 1, F.lit(1)))
                .when(c.rlike("[a-z]"), F.char(F.lit(97) + b % 26)).when(c.rlike("[A-Z]"), F.char(F.lit(65) + b % 26)).otherwise(c))

    return F.array_join(F.transform(F.split(value, "(?!^)(?=.)"), one), "")


def surrogate(kind: Column, value: Column, key: Column, salt: Column) -> Column:
    """Replacement of a value: kind is form, name-m, name-f (given names) or name-n (family names)."""
    s = _stream(F.concat_ws("/", key, kind), value, salt)
    n = [_byte(s, F.lit(i)) * 256 + _byte(s, F.lit(i + 1)) for i in range(0, 12, 2)]
    at = F.instr(value, "@")
    domain = F.substr(value, at + 1)
    host = F.regexp_extract(domain, r"^(.*)\.[^.]*$", 1)
    # the same host has the same replacement in all addresses
    email = F.concat(_like(F.substr(value, F.lit(1), at - 1), s), F.lit("@"), _like(host, _stream(F.concat_ws("/", key, F.lit("host")), host, F.lit(0))),
                     F.regexp_extract(domain, r"(\.[^.]*)$", 1))
    address = F.concat_ws(".", 1 + n[0] % 223, n[1] % 256, n[2] % 256, 1 + n[3] % 254)

    def name(script: str, first: list[str]) -> Column:
        family = _pick(END[script + "n"], n[2])
        if script == "c":
            # the form of a Slavic family name tells the gender, or that it has one form for both
            family = (F.when(value.endswith(NEUTRAL[0]), NEUTRAL[0]).when(value.rlike("[ая]$"), _pick(END["cw"], n[2])).otherwise(family))
        ends = F.when(kind == "name-m", _pick(END[script + "m"], n[2])).when(kind == "name-f", _pick(END[script + "f"], n[2])).otherwise(family)
        # each draw adds a syllable, so there are always more names than are taken
        more = F.transform(F.sequence(F.lit(0), F.least(salt, F.lit(40)) + 1), lambda i: _pick(MIDDLE[script], _byte(s, i + 12)))
        return F.concat(_pick(first, n[0]), F.array_join(more, ""), ends)

    return (F.when(kind != "form", F.when(value.rlike(r"\p{IsCyrillic}"), name("c", CYRILLIC)).otherwise(name("l", LATIN)))
            .when(at > 0, email).when(value.rlike(f"^{ADDRESS}$"), address).otherwise(_like(value, s)))


def _names(text: Column) -> Column:
    """Words of names after a form of address: array of (value, kind), a given name by gender before a family name."""
    found = F.regexp_extract_all(text, F.lit(ADDRESSED), F.lit(0))

    def words(x: Column) -> Column:
        body = F.split(F.regexp_replace(x, r"^\S+ ", ""), " ")
        kind = F.when(x.rlike(f"^(?:{MALE})"), "name-m").otherwise("name-f")
        given = F.struct(F.element_at(body, 1).alias("value"), kind.alias("kind"))
        family = F.struct(F.element_at(body, -1).alias("value"), F.lit("name-n").alias("kind"))
        return F.when(F.size(body) > 1, F.array(given, family)).otherwise(F.array(family))

    return F.flatten(F.transform(found, words))


def _any(text: Column, parts: list[str]) -> Column:
    return functools.reduce(operator.or_, (text.contains(p) for p in parts))


def _found(docs: DataFrame) -> DataFrame:
    """docs with the row's pattern, its hits in order and the names among them.

    The patterns run only on texts that hold what each form needs: a digit, an at sign, a label or a form of address.
    """
    text = F.col("text")
    polite = _any(text, [t + end for t in f"{MALE}|{FEMALE}".split("|") for end in (" ", ".")])
    named = docs.withColumn("_names", F.when(polite, _names(text)))
    likely = text.rlike("[0-9@]") | _any(text, LABELS)
    alternatives = F.array_join(F.array_distinct(F.transform(F.col("_names"), lambda x: F.replace(x["value"], F.lit("-"), F.lit(r"\-")))), "|")
    pattern = F.when(F.size("_names") > 0, F.concat(F.lit(FORMS + r"|(?<!\p{L})(?:"), alternatives, F.lit(r")(?!\p{L})"))).otherwise(F.lit(FORMS))
    plain = F.when(likely, F.regexp_extract_all(text, F.lit(FORMS), F.lit(0)))
    named = named.withColumn("_pattern", pattern)
    return named.withColumn("_hits", F.when(F.size("_names") > 0, F.regexp_extract_all(F.col("text"), F.col("_pattern"), F.lit(0))).otherwise(plain))


def _kind(hit: Column) -> Column:
    known = F.filter("_names", lambda x: x["value"] == hit)
    return F.when(F.size(known) > 0, F.array_min(F.transform(known, lambda x: x["kind"]))).otherwise(F.lit("form"))


def entities(docs: DataFrame, key: str, path: str) -> DataFrame:
    """(kind, value, salt, surrogate) of each distinct entity, with no two alike and none that is itself an entity.

    A surrogate taken twice stays with the least value; others, and those that equal an entity of the table, are drawn
    anew with the next salt until none is left. Names get longer with each draw, so any number of them is served; other entities keep
    their format, and the job fails only when a format has no values left, that is when STALLED rounds in a row settle none.
    """
    hits = F.transform("_hits", lambda h: F.struct(_kind(h).alias("kind"), h.alias("value")))
    found = _found(docs)
    drawn = lambda df: df.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.lit(key), F.col("salt")))
    now = storage.kept(drawn(found.where(F.size("_hits") > 0).select(F.explode(hits).alias("e")).select("e.*").distinct().withColumn("salt", F.lit(0))),
                       f"{path}/entities-0")
    least = stalled = turn = 0
    while True:
        turn += 1
        first = now.groupBy("surrogate").agg(F.min(F.struct("value", "kind")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        real = now.select(F.col("value").alias("surrogate"), F.lit(True).alias("real")).distinct()
        clash = (now.join(first, "surrogate", "left").join(real, "surrogate", "left")
                 .withColumn("again", F.coalesce(F.col("real"), F.lit(False)) | F.coalesce(F.struct("value", "kind") != F.col("first"), F.lit(False))))
        clash = storage.kept(clash.select("kind", "value", "salt", "surrogate", "again"), f"{path}/clash-{turn}")
        left = clash.where("again").count()
        if not left:
            return now
        stalled = 0 if turn == 1 or left < least else stalled + 1
        least = left if turn == 1 else min(least, left)
        if stalled == STALLED:
            raise RuntimeError("a format of entities has no surrogates left")
        redrawn = drawn(clash.where("again").drop("surrogate", "again").withColumn("salt", F.col("salt") + 1))
        now = storage.kept(clash.where("not again").drop("again").unionByName(redrawn.select("kind", "value", "salt", "surrogate")), f"{path}/entities-{turn}")


def replace(docs: DataFrame, key: str = "zonewright") -> DataFrame:
    """docs with personal data and secrets in `text` replaced, and n_entities (long): one row per input row, all columns kept.

    Emails, addresses, phone and card numbers, secrets, and names after a form of address are replaced; a name found
    once in a text is replaced wherever it stands there. The surrogate follows from the key, the type and the value
    alone, so an entity has the same one in all texts and runs; it has the format, script and gender of the value. No
    two entities share a surrogate and none is an entity of the table (see entities()). Texts without any are
    unchanged; NULL and empty texts stay, with 0 entities; texts of any length are searched whole. Other columns come back
    untouched, whatever their names; an own column n_entities is replaced. An empty table gives an empty result.
    """
    path = storage.run_dir(docs.sparkSession, "surrogates")
    moved = storage.kept(entities(docs.select(F.col("text").cast("string").alias("text")), key, path).where("salt > 0").select("kind", "value", "surrogate"),
                         f"{path}/moved")
    names = [c for c in docs.columns if c != "n_entities"]
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names) if c != "text"]
    # own columns travel in one struct, so that the working columns beside it clash with none of them
    found = _found(docs.select(F.col("text").cast("string").alias("text"), F.struct(*(others or [F.lit(0)])).alias("_own")))
    drawn = F.transform("_hits", lambda h: surrogate(_kind(h), h, F.lit(key), F.lit(0)))
    if not moved.isEmpty():
        # texts with an entity whose first surrogate was taken get the ones drawn later
        row = F.xxhash64("text")
        other = (found.where(F.size("_hits") > 0).select(row.alias("_row"), F.explode(F.transform("_hits", lambda h: F.struct(_kind(h).alias("kind"), h.alias("value")))).alias("e"))
                 .select("_row", "e.*").distinct().join(moved, ["kind", "value"]).groupBy("_row").agg(F.collect_set(F.struct("kind", "value", "surrogate")).alias("_moved")))
        found = found.withColumn("_row", row).join(other, "_row", "left").drop("_row")

        def one(h: Column) -> Column:
            known = F.filter("_moved", lambda m: (m["value"] == h) & (m["kind"] == _kind(h)))
            return F.coalesce(F.element_at(F.transform(known, lambda m: m["surrogate"]), 1), surrogate(_kind(h), h, F.lit(key), F.lit(0)))

        drawn = F.when(F.col("_moved").isNotNull(), F.transform("_hits", lambda h: F.when(F.exists("_moved", lambda m: m["value"] == h), one(h))
                                                                .otherwise(surrogate(_kind(h), h, F.lit(key), F.lit(0))))).otherwise(drawn)
    parts = F.split(F.col("text"), F.col("_pattern"), -1)
    rebuilt = F.array_join(F.zip_with(parts, F.col("_drawn"), lambda p, d: F.concat(p, F.coalesce(d, F.lit("")))), "")
    out = found.withColumn("_drawn", F.when(F.size("_hits") > 0, drawn))
    text = F.when(F.size("_hits") > 0, rebuilt).otherwise(F.col("text"))
    back = [text.alias(c) if c == "text" else F.col("_own")[f"c{i}"].alias(c) for i, c in enumerate(names)]
    return out.select(*back, F.coalesce(F.greatest(F.size("_hits"), F.lit(0)), F.lit(0)).cast("long").alias("n_entities"))
