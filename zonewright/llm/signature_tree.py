"""Jaccard self-join of word-shingle sets by signature trees.

The trees do the join: inner nodes hold the OR of their sets' bitmaps and the range of their sizes, two trees are
walked together, and a node pair is dropped when the most its sets could share is below what the threshold needs.
So that a tree fits one task, sets are first put into blocks. Of n shingles, the n - ceil(t n) + 1 rarest (in an order
that all sets share) must hold one of any set linked with it, so sets that share none of those and are linked by no
chain of such sets are in different blocks. Rarity comes from hashed counts over the whole table in 2^18 counters.

A first pass over the blocks uses the bitmaps alone and leaves the texts of documents that may have a partner; only
those are moved for the exact pass. Blocks too large for a task are cut into pieces. Each piece is joined in itself, then the pieces' largest components
with each other, then whatever is not in the block's largest component with all pieces. A pair of one component
needs no test, so copies cost no pairs, and each pair across components is still tested by the trees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from zonewright.llm import graph, storage, words

COUNTERS = 1 << 18
SLICE = 1 << 14
UNIT_TOKENS = 1 << 21
MAP_BYTES = 1 << 24
SCREEN = 1 << 26
SCREEN_SLICE = 1 << 16
BUCKET_ENTRIES = 1 << 18
LEAF = 8
FAN = 8
PAIRS = 1 << 13

_PROFILE = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("map", pa.binary()),
                      ("slice", pa.int32()), ("counts", pa.binary())])
_ENTRY = pa.schema([("bucket", pa.int32()), ("token", pa.binary()), ("doc", pa.binary()), ("low", pa.binary()),
                    ("high", pa.binary()), ("edge", pa.binary())])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, the same whatever the order of its members."""
    a, b = words.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), words.mix(tokens + np.uint64(0x14057B7EF767814F))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64))


def needed(n: np.ndarray | int, percent: int):
    """Least overlap that a set of n shingles has with any set linked with it."""
    return -(-percent * n // 100)


def bitmap(tokens: np.ndarray) -> bytes:
    """Bits of the members' hashes, at least two for each member up to 16,384 bits; a power of two, so that maps can be tiled."""
    bits = 1 << int(np.clip(np.ceil(np.log2(2 * max(1, len(tokens)))), 7, 14))
    flags = np.zeros(bits, bool)
    flags[(tokens >> np.uint64(20)) % np.uint64(bits)] = True
    return np.packbits(flags).tobytes()


def profile(docs: DataFrame, k: int) -> DataFrame:
    """One row per document (size and fingerprint of its set) and, for each task, its counters of shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            ids, text = words.rows_of(batch, ["doc_id", "text"])
            out, gathered, held = [], [], 0
            for tokens in words.shingle_sets(text, k):
                out.append((len(tokens), *fingerprint(tokens), bitmap(tokens)))
                gathered.append((tokens % np.uint64(COUNTERS)).astype(np.int32))
                held += len(tokens)
                if held > words.CHUNK:
                    counts += np.bincount(np.concatenate(gathered), minlength=COUNTERS)
                    gathered, held = [], 0
            if gathered:
                counts += np.bincount(np.concatenate(gathered), minlength=COUNTERS)
            cols = [pa.array([r[i] for r in out], _PROFILE.field(i + 1).type) for i in range(4)]
            empty = pa.nulls(len(out))
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), *cols, empty.cast(pa.int32()), empty.cast(pa.binary())], schema=_PROFILE)
        if counts.any():
            rows = [{"slice": s, "counts": counts[s * SLICE : (s + 1) * SLICE].tobytes()} for s in range(COUNTERS // SLICE)]
            yield pa.RecordBatch.from_pylist(rows, schema=_PROFILE)

    return docs.select("doc_id", "text").mapInArrow(run, _ddl(_PROFILE))


def rarity(profiled: DataFrame) -> np.ndarray:
    """Class of each counter: 0 for the usual count, more the further it is above. 2^18 counters at most reach the driver."""

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.int64)
        for c in t.column("counts"):
            total += np.frombuffer(c.as_py(), np.int64)
        return pa.table({"slice": pa.array([t.column("slice")[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    part = (profiled.where("slice is not null").select((F.col("slice") + 1000 * F.pmod(F.xxhash64("counts"), F.lit(16))).cast("int").alias("slice"), "counts")
            .groupBy("slice").applyInArrow(add, "slice int, counts binary").withColumn("slice", (F.col("slice") % 1000).cast("int"))
            .groupBy("slice").applyInArrow(add, "slice int, counts binary"))
    counts = np.zeros(COUNTERS, np.int64)
    for r in part.collect():
        counts[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["counts"], np.int64)
    mean = counts.mean()
    above = np.maximum(counts - mean - 6 * np.sqrt(mean + 1), 1)
    return np.minimum(np.floor(np.log2(above) / 2), 200).astype(np.uint8)


def _sweep(token: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Entries sorted by token and size, where each chain starts, and its root: the least document in it.

    A chain holds entries of one token whose size ranges are near enough for a link, directly or through others.
    """
    order = np.lexsort((low, token))
    token, doc, low, high = token[order], doc[order], low[order], high[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = token[1:] != token[:-1]
    lift = (np.cumsum(fresh) - 1) << 40
    most = np.maximum.accumulate(lift + high) - lift
    start = fresh.copy()
    start[1:] |= most[:-1] * 100 < percent * low[1:]
    at = np.flatnonzero(start)
    return token, doc, low, high, at, np.minimum.reduceat(doc, at) if len(at) else doc


def _pairs(doc: np.ndarray, at: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Distinct (document, root of its chain) where the two differ."""
    of = np.repeat(root, np.diff(np.append(at, len(doc))))
    return np.unique(np.stack([doc, of], 1)[doc != of], axis=0)


def chains(docs: DataFrame, k: int, percent: int, rare: np.ndarray, buckets: int) -> DataFrame:
    """(local, a, b): document a is in the chain with root b. Chains are made in each task first (local), then for all.

    Any two documents that may be linked share a rare token in the first ones of each, so they are in one chain.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rare)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, seen = shared.value, set()
        token, doc, size = [], [], []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not token:
                return
            count = [len(t) for t in token]
            n = np.repeat(np.array(size, np.int64), count)
            t, d, low, high, at, root = _sweep(np.concatenate(token), np.repeat(np.array(doc, np.int64), count), n, n, percent)
            edge = _pairs(d, at, root)
            t, d, low, high = t[at], root, low[at], np.maximum.reduceat(high, at)
            bucket, home = (t % np.uint64(buckets)).astype(np.int64), edge[:, 0] % buckets
            order, order_e = np.argsort(bucket, kind="stable"), np.argsort(home, kind="stable")
            present = np.union1d(bucket, home)  # only these, as there are many more buckets than entries in a large table
            ends = [(np.searchsorted(x[o], present, "left"), np.searchsorted(x[o], present, "right")) for x, o in ((bucket, order), (home, order_e))]
            rows = []
            for i, a, b, a_e, b_e in zip(present.tolist(), *ends[0], *ends[1]):
                pick, links = order[a:b], edge[order_e[a_e:b_e]]
                rows.append({"bucket": i, "token": t[pick].tobytes(), "doc": d[pick].tobytes(), "low": low[pick].astype(np.int32).tobytes(),
                             "high": high[pick].astype(np.int32).tobytes(), "edge": links.tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY)

        for batch in batches:
            ids, text = words.rows_of(batch, ["doc_id", "text"])
            for i, tokens in enumerate(words.shingle_sets(text, k)):
                n = len(tokens)
                key = fingerprint(tokens)
                if not n or key in seen:
                    continue
                seen.add(key)
                p = n - needed(n, percent) + 1
                rank = classes[(tokens % np.uint64(COUNTERS)).astype(np.int64)]
                if rank.any():
                    tokens = tokens[np.argsort(rank, kind="stable")]
                token.append(tokens[:p].copy())
                doc.append(ids[i].as_py())
                size.append(n)
                held += p
                if held > words.CHUNK // 2:
                    yield from flush()
                    token, doc, size, held = [], [], [], 0
        yield from flush()

    def chain(t: pa.Table) -> pa.Table:
        def whole(name: str, kind: type) -> np.ndarray:
            return np.concatenate([np.frombuffer(x.as_py(), kind) for x in t.column(name)])

        _, doc, _, _, at, root = _sweep(whole("token", np.uint64), whole("doc", np.int64), whole("low", np.int32).astype(np.int64),
                                        whole("high", np.int32).astype(np.int64), percent)
        met, local = _pairs(doc, at, root), np.unique(whole("edge", np.int64).reshape(-1, 2), axis=0)
        both = np.concatenate([met, local])
        return pa.table({"local": pa.array(np.arange(len(both)) >= len(met)), "a": pa.array(both[:, 0]), "b": pa.array(both[:, 1])})

    packed = docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(pack, _ddl(_ENTRY))
    return packed.groupBy("bucket").applyInArrow(chain, "local boolean, a bigint, b bigint").distinct()


def blocks_of(chained: DataFrame) -> DataFrame:
    """(doc_id, block): a block for each chain; what was chained in a task is in all blocks of its root there."""
    met = chained.where("not local").select("a", "b")
    local = chained.where("local").select("a", "b")
    through = local.withColumnRenamed("b", "r").join(met.select(F.col("a").alias("r"), "b"), "r").select("a", "b")
    pairs = met.unionByName(local).unionByName(through)
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), "b")).select(F.col("a").alias("doc_id"), F.col("b").alias("block")).distinct()


class _Tree:
    """Levels of nodes over documents in a given order; level 0 are the documents themselves."""

    def __init__(self, maps: np.ndarray, size: np.ndarray, spare: np.ndarray, block: np.ndarray) -> None:
        self.levels = [(maps, size, size, spare, block, block)]
        step = LEAF
        while len(self.levels[-1][0]) > 1:
            m, lo, hi, sp, b0, b1 = self.levels[-1]
            at = np.arange(0, len(m), step)
            self.levels.append((np.bitwise_or.reduceat(m, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                                np.maximum.reduceat(sp, at), np.minimum.reduceat(b0, at), np.maximum.reduceat(b1, at)))
            step = FAN

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child and number of children of each node."""
        step = LEAF if level == 1 else FAN
        first = nodes * step
        return first, np.minimum(first + step, len(self.levels[level - 1][0])) - first


def _fits(tree: _Tree, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether node pairs may hold a linked pair: blocks and sizes meet, and the bitmaps allow the overlap needed."""
    maps, lo, hi, spare, b0, b1 = tree.levels[level]
    ok = (b0[i] <= b1[j]) & (b0[j] <= b1[i]) & (hi[i] * 100 >= percent * lo[j]) & (hi[j] * 100 >= percent * lo[i])
    at = np.flatnonzero(ok)
    for s in range(0, len(at), PAIRS):
        part = at[s : s + PAIRS]
        a, b = i[part], j[part]
        most = np.bitwise_count(maps[a] & maps[b]).sum(1, dtype=np.int64) + np.minimum(spare[a], spare[b])
        ok[part] = most * (100 + percent) >= percent * (lo[a] + lo[b])
    return ok


def _plant(maps: list[bytes], size: np.ndarray, block: np.ndarray) -> _Tree:
    """Tree of sets in the given order. Narrow maps are tiled to the widest: common members still share a bit."""
    width = max(len(m) for m in maps)
    bits = np.stack([np.tile(np.frombuffer(m, np.uint8), width // len(m)) for m in maps]).view(np.uint64)
    own = np.array([int.from_bytes(m, "big").bit_count() for m in maps], np.int64)
    return _Tree(bits, size, size - own, block)


def _walk(tree: _Tree, block: np.ndarray, percent: int, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of documents of one block that the bitmaps leave, some at a time; `wanted` says which are still asked for."""
    stack = [(len(tree.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        if len(i) > PAIRS // 8 and level:
            half = len(i) // 2
            stack += [(level, i[half:], j[half:]), (level, i[:half], j[:half])]
            continue
        if not level:
            ok = wanted(i, j)
            i, j = i[ok], j[ok]
        ok = _fits(tree, level, i, j, percent)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if not level:
            yield i, j
            continue
        fi, ni = tree.children(level, i)
        fj, nj = tree.children(level, j)
        pair = np.repeat(np.arange(len(i)), ni * nj)
        inner = np.arange(len(pair)) - np.repeat(np.cumsum(ni * nj) - ni * nj, ni * nj)
        ci, cj = fi[pair] + inner // nj[pair], fj[pair] + inner % nj[pair]
        once = ci <= cj if level > 1 else (ci < cj) & (block[ci] == block[cj])
        if once.any():
            stack.append((level - 1, ci[once], cj[once]))


def paired(maps: list[bytes], size: np.ndarray, block: np.ndarray, percent: int) -> np.ndarray:
    """Flags of the sets that may be linked with another of their block, as far as bitmaps and sizes tell."""
    order = np.lexsort((size, block))
    found = np.zeros(len(order), bool)
    tree = _plant([maps[i] for i in order], size[order], block[order])
    for i, j in _walk(tree, block[order], percent, lambda x, y: ~(found[x] & found[y])):
        found[i] = True
        found[j] = True
    flags = np.zeros(len(order), bool)
    flags[order] = found
    return flags


def tree_join(docs: np.ndarray, sets: list[np.ndarray], block: np.ndarray, label: np.ndarray, side: np.ndarray | None,
              percent: int) -> list[tuple[int, int]]:
    """Links that join the labels of linked documents; pairs already joined are left out.

    `side` (0 or 1) asks only for pairs with a document of side 1.
    """
    size = np.array([len(s) for s in sets], np.int64)
    least = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
    order = np.lexsort((least, size, block))
    order = order[size[order] > 0]
    if len(order) < 2:
        return []
    docs, block, label, size = docs[order], block[order], label[order], size[order]
    sets = [sets[i] for i in order]
    side = None if side is None else side[order]
    _, root = np.unique(label, return_inverse=True)
    parent = np.arange(root.max() + 1)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def wanted(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        up = parent
        while (up[up] != up).any():
            up = up[up]
        apart = up[root[i]] != up[root[j]]
        return apart if side is None else apart & ((side[i] | side[j]) > 0)

    links = []
    for i, j in _walk(_plant([bitmap(s) for s in sets], size, block), block, percent, wanted):
        for x, y in zip(i.tolist(), j.tolist()):
            a, b = find(root[x]), find(root[y])
            if a == b:
                continue
            common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if common * 100 >= percent * (len(sets[x]) + len(sets[y]) - common):
                parent[max(a, b)] = min(a, b)
                links.append((int(docs[x]), int(docs[y])))
    return links


def _screened(docs: DataFrame, members: DataFrame) -> DataFrame:
    """docs without most of the rows whose doc_id is not in members: a bitmap of 2^26 hashed ids, 8 MB, says which may be."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SCREEN))

    def bits(t: pa.Table) -> pa.Table:
        flags = np.zeros(SCREEN_SLICE, bool)
        flags[t.column("slot").to_numpy() % SCREEN_SLICE] = True
        return pa.table({"slice": t.column("slice")[:1], "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    slots = members.select(slot.alias("slot")).distinct().withColumn("slice", F.col("slot").bitwiseAND(-SCREEN_SLICE))
    screen = np.zeros(SCREEN // 8, np.uint8)
    for r in slots.groupBy("slice").applyInArrow(bits, "slice bigint, bits binary").collect():
        screen[r["slice"] // 8 : (r["slice"] + SCREEN_SLICE) // 8] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(screen)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            kept = (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            yield batch.select([0, 1]).filter(pa.array(kept.astype(bool)))

    return (docs.where("doc_id is not null").select("doc_id", "text", slot.alias("slot"))
            .mapInArrow(keep, "doc_id bigint, text string"))


def _join_units(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Links within each unit. rows: unit, doc_id, block, label, side (NULL or 0, 1), text."""

    def run(t: pa.Table) -> pa.Table:
        docs, block, label = (t.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "block", "label"))
        side = None if t.column("side").null_count else t.column("side").to_numpy()
        links = tree_join(docs, list(words.shingle_sets(t.column("text"), k)), block, label, side, percent)
        return pa.Table.from_pylist([{"a": a, "b": b} for a, b in links], schema=_LINK)

    return rows.groupBy("unit").applyInArrow(run, _ddl(_LINK))


def _relabel(members: DataFrame, links: DataFrame, path: str) -> DataFrame:
    """members with `label` replaced by the least label its links reach."""
    labels = members.select("doc_id", "label").distinct()
    ends = (links.join(labels.select(F.col("doc_id").alias("a"), F.col("label").alias("la")), "a")
            .join(labels.select(F.col("doc_id").alias("b"), F.col("label").alias("lb")), "b").where("la != lb"))
    found = graph.components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")), path)
    return (members.join(found.withColumnRenamed("node", "label"), "label", "left")
            .withColumn("label", F.coalesce("component", "label")).drop("component"))


def _pieces(weight: Column) -> Column:
    return F.ceil(weight / UNIT_TOKENS).cast("int")


def links_of(docs: DataFrame, k: int, percent: int, profiled: DataFrame, path: str) -> DataFrame:
    """(a, b) links that connect whatever documents with different sets are linked, directly or by others."""
    total = profiled.where("n_shingles > 0").select(F.sum(F.expr(f"n_shingles - ceil({percent} * n_shingles / 100) + 1")).alias("n")).first()["n"]
    spark = docs.sparkSession
    if not total:
        return spark.createDataFrame([], _ddl(_LINK))
    chained = storage.kept(chains(docs, k, percent, rarity(profiled), max(64, int(total // BUCKET_ENTRIES))), f"{path}/chains")
    held = (profiled.where("n_shingles > 0").groupBy("doc_id")
            .agg(F.sum("n_shingles").alias("n"), F.max(F.length("map")).alias("bytes"), F.count(F.lit(1)).alias("rows"),
                 F.max("map").alias("map")))
    sized = storage.kept(blocks_of(chained).join(held.drop("map"), "doc_id"), f"{path}/sized")
    spread = (sized.groupBy("block").agg(F.sum("bytes").alias("map_bytes"), F.max("n").alias("most"), F.max("rows").alias("rows"))
              .withColumn("whole", F.expr(f"rows > 1 or map_bytes > {MAP_BYTES}")))
    some = int(sized.agg(F.sum("bytes")).first()[0] or 0) // (MAP_BYTES // 4)
    bin_of = F.concat_ws("-", F.floor(F.log2("most")), F.pmod(F.xxhash64("block"), F.lit(max(4, some))))

    def filtered(t: pa.Table) -> pa.Table:
        block, size = (t.column(c).to_numpy().astype(np.int64) for c in ("block", "n"))
        return t.select(["doc_id", "block", "n"]).filter(pa.array(paired([m.as_py() for m in t.column("map")], size, block, percent)))

    judged = sized.join(spread, "block")
    left = (judged.where("not whole").join(held.select("doc_id", "map"), "doc_id")
            .select(bin_of.alias("unit"), "doc_id", "block", "n", "map").groupBy("unit")
            .applyInArrow(filtered, "doc_id bigint, block bigint, n bigint"))
    sized = storage.kept(left.unionByName(judged.where("whole").select("doc_id", "block", "n")), f"{path}/paired")
    storage.drop(spark, f"{path}/profile", f"{path}/chains", f"{path}/sized")  # the bitmaps, mostly; all that follows starts from `paired`
    weights = sized.groupBy("block").agg(F.sum("n").alias("weight"))
    members = storage.kept(sized.join(weights, "block").withColumn("label", F.col("doc_id")), f"{path}/members")
    bins = max(8, int((members.where(f"weight <= {UNIT_TOKENS}").agg(F.sum("n")).first()[0] or 0) // (UNIT_TOKENS // 4)))
    piece = F.pmod(F.xxhash64("doc_id"), _pieces(F.col("weight")))
    small = F.concat(F.lit("s"), F.pmod(F.xxhash64("block"), F.lit(bins)))
    unit = F.when(F.col("weight") <= UNIT_TOKENS, small).otherwise(F.concat_ws("-", F.lit("p"), F.col("block"), piece))
    none = F.lit(None).cast("int")

    texts = _screened(docs, members)

    def joined(rows: DataFrame, name: str) -> DataFrame:
        return storage.kept(_join_units(rows.join(texts, "doc_id")
                                        .select("unit", "doc_id", "block", "label", "side", "text"), k, percent), f"{path}/links-{name}")

    first = joined(members.withColumn("unit", unit).withColumn("side", none), "1")
    large = members.where(f"weight > {UNIT_TOKENS}").withColumn("piece", piece)
    if large.isEmpty():
        return first
    large = storage.kept(_relabel(large, first, f"{path}/relabel-1"), f"{path}/large-1")
    counted = large.groupBy("block", "piece", "label").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"))
    heads = counted.groupBy("block", "piece").agg(F.max_by(F.struct("label", "doc_id"), F.struct("n", "label")).alias("h"))
    heads = heads.select(F.concat_ws("-", F.lit("h"), "block").alias("unit"), "h.doc_id", "block", "h.label", none.alias("side"))
    second = joined(heads, "2")
    large = storage.kept(_relabel(large, second, f"{path}/relabel-2"), f"{path}/large-2")
    by_label = large.groupBy("block", "label").agg(F.sum("n").alias("n"))
    main = by_label.groupBy("block").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("top"))
    rest = main.withColumn("groups", F.greatest(F.lit(1), _pieces(F.col("all") - F.col("top")))).where("all > top")
    facing = large.join(rest, "block").withColumn("group", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("groups")))
    minor = facing.where("label != main")
    across = (minor.withColumn("other", F.explode(F.expr(f"sequence(0, cast(ceil(weight / {UNIT_TOKENS}) as int) - 1)")))
              .select("block", "doc_id", "label", "group", F.col("other").alias("piece"), F.lit(1).alias("side"))
              .unionByName(facing.withColumn("group", F.explode(F.expr("sequence(0, cast(groups as int) - 1)")))
                           .select("block", "doc_id", "label", "group", "piece", F.lit(0).alias("side"))))
    across = across.groupBy("block", "doc_id", "label", "group", "piece").agg(F.max("side").alias("side"))
    third = joined(across.withColumn("unit", F.concat_ws("-", F.lit("x"), "block", "group", "piece")), "3")
    return first.unionByName(second).unionByName(third)


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): groups of documents chained by 100 * |x and y| >= percent * |x or y|.

    Sets are the distinct k-word shingles of the whole text, A-Z lower-cased, words between ASCII white space; a text
    with fewer words is one shingle, one without words has none and is alone. Shingles are compared by 64-bit hashes and
    equal sets found by 128-bit fingerprints. One row per input row. Rows without doc_id are in no group (component_id
    NULL); rows that share a doc_id count as one document. Other columns are ignored. Ties: the smallest doc_id names the group.
    """
    path = storage.run_dir(docs.sparkSession, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profiled = storage.kept(profile(docs, k), f"{path}/profile")
    per_doc = storage.kept(profiled.where("slice is null").select("doc_id", "n_shingles", "fp1", "fp2"), f"{path}/documents")
    links = links_of(docs, k, percent, profiled, path)
    shape = ["n_shingles", "fp1", "fp2"]
    named = per_doc.where("doc_id is not null and n_shingles > 0")
    classes = named.groupBy(*shape).agg(F.min("doc_id").alias("b"))
    same = named.join(classes, shape).where("doc_id != b").select(F.col("doc_id").alias("a"), "b")
    found = storage.kept(graph.components(links.unionByName(same), f"{path}/components"), f"{path}/component")
    return (per_doc.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
