"""Operator 1: SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlake.llm.common import bitmap, components, discard, guarded, held_bits, sieve, spaced_words, stored, table, trim_memory

CHUNK = 50_000
MASK = (1 << 64) - 1


def shingles(words: list[bytes], k: int) -> list[bytes]:
    """Runs of k words joined by a space; the whole sequence where there are fewer words, nothing where there is none."""
    if k == 1 or not words:
        return words
    return [b" ".join(words)] if len(words) < k else list(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def mixed(h: np.ndarray, index: int) -> np.ndarray:
    """Hashes for the index-th fingerprint; the first takes them as they are."""
    if not index:
        return h
    h = (h ^ np.uint64(index * 0x9E3779B97F4A7C15 & MASK)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def fingerprints_of(text: str | None, k: int, bits: int, count: int, distinct: bool, seed: int = 42) -> list[int]:
    """So many fingerprints of the text, as signed integers; a bit is 1 if over half of the hashes have it."""
    found = shingles(spaced_words(text or ""), k)
    found = list(set(found)) if distinct else found
    if not found:
        return [0] * count
    sums = np.zeros((count, 64), dtype=np.int64)
    for start in range(0, len(found), CHUNK):
        part = found[start : start + CHUNK]
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(seed)), dtype=np.uint64, count=len(part))
        for i in range(count):
            ones = np.unpackbits(mixed(h, i).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            sums[i] += ones.sum(0, dtype=np.uint16)
    packed = np.packbits(sums * 2 > len(found), axis=1).reshape(-1).view(">u8").astype(np.uint64) >> np.uint64(64 - bits)
    return packed.view(np.int64).tolist()


def fingerprint(text: Column, k: int = 3, bits: int = 64, count: int = 1, distinct: bool = False) -> Column:
    """An array of fingerprints of whole texts. Null and wordless texts get fingerprints of zero."""

    @F.arrow_udf("array<long>")
    def prints(texts: pa.Array) -> pa.Array:
        trim_memory()
        return pa.array([fingerprints_of(t.as_py(), k, bits, count, distinct) for t in texts], type=pa.list_(pa.int64()))

    return prints(text)


def near_links(prints: DataFrame, fp: str = "fp") -> DataFrame:
    """(a, b): links between 64-bit fingerprints, as many as join all that differ in 3 bits or fewer.

    Meeting in the middle of radius 3: every fingerprint emits the variants within 1 bit, and those of odd parity also
    the variants with two flips in one half. Of two that differ in three bits, one has odd parity and two of the three
    bits share a half, so they meet; smaller distances meet within 1 bit. A variant can be reached from at most 2,081
    fingerprints, so no bucket grows with the data. Its smallest fingerprint within 1 bit is within 3 of all others in
    the bucket, hence one link per member joins what all pairs would.

    Before that, fingerprints go that cannot link: two within 3 bits differ in at most one bit of one half, so a
    fingerprint none of whose half variants another one shares stays alone. Only smallest and largest fingerprints per
    half variant are gathered, so a half that very many share needs no group. Nulls are left out.
    """
    prints = prints.select(F.col(fp).alias("fp")).where("fp is not null").distinct()
    half = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.shiftrightunsigned("fp", 32).alias("half")), F.struct(F.lit(1).alias("side"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("half"))))
    flips = F.expr("if(bit_count(h.half) % 2 = 1, concat(array(0L), transform(sequence(0, 31), i -> shiftleft(1L, i))), array(0L))")
    halves = (
        prints.select("fp", half.alias("h"))
        .select("fp", F.col("h.side").cast("long").alias("side"), F.col("h.half").alias("half"), F.explode(flips).alias("flip"))
        .select("fp", F.expr("(half ^ flip) | shiftleft(side, 32)").alias("variant"))
    )
    shared = halves.groupBy("variant").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo != hi").select("variant")
    some = stored(halves.join(shared, "variant", "left_semi").select("fp").distinct(), "simhash-some")
    masks = F.expr(
        "concat(array(0L), flatten(transform(sequence(0, 63), i -> transform(sequence(i, shiftright(i, 5) * 32 + 31), "
        "j -> shiftleft(1L, i) | shiftleft(1L, j)))))"
    )
    balls = (
        some.select("fp", F.explode(masks).alias("mask"))
        .where("bit_count(mask) < 2 or bit_count(fp) % 2 = 1")
        .select("fp", F.expr("fp ^ mask").alias("variant"), F.expr("if(bit_count(mask) < 2, fp, null)").alias("close"))
    )
    hub = F.min("close").over(Window.partitionBy("variant"))
    return (
        balls.select("fp", hub.alias("hub"))
        .where("hub != fp")
        .select(F.col("fp").alias("a"), F.col("hub").alias("b"))
        .distinct()
        .where("bit_count(a ^ b) <= 3")
    )


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) of every row of documents, by 64-bit fingerprints of 3-word shingles.

    Fingerprints that differ in 3 bits or fewer link, and component_id is the smallest doc_id that can be reached. Null
    and wordless texts have fingerprint zero and link like any other; repeated rows come back as often; a null doc_id
    is never the smallest, unless a component has no other. An empty table gives no rows. Other columns are not read.
    """
    prints = stored(docs.select("doc_id", fingerprint(F.col("text"))[0].alias("fp")), "simhash-prints")
    groups = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-groups")
    roots = stored(components(near_links(groups), "a", "b", "simhash-step"), "simhash-roots")
    linked = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op1(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


# Near-duplicates by similarity: fingerprints, then shared prefixes of shingle sets, propose, whole sets decide.


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """The distinct k-word shingles as sorted 64-bit hashes; words are hashed once each and combined by place."""
    words = spaced_words(text or "")
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    m = min(k, len(h))
    if not m:
        return np.zeros(0, dtype=np.int64)
    total = np.full(len(h) - m + 1, m, dtype=np.uint64)
    for i in range(m):
        total = mixed(total, 1) + h[i : len(h) - m + 1 + i]
    return np.unique(mixed(total, 1).view(np.int64))


def shingle_set(text: Column, k: int) -> Column:
    """The distinct k-word shingles of whole texts as sorted 64-bit hashes."""

    @F.arrow_udf("array<long>")
    def sets(texts: pa.Array) -> pa.Array:
        trim_memory()
        return pa.array([shingle_hashes(t.as_py(), k) for t in texts], type=pa.list_(pa.int64()))

    return sets(text)


def prefix_length(size: int, least: float) -> int:
    """So many first shingles, in any order that all texts share, hold one of every text that is similar enough.

    Two sets with a similarity of `least` or more share least * size shingles or more of either, so the first shared
    one has at least that many in its own set from its place on.
    """
    return size - int(np.ceil(least * size - 1e-9)) + 1


def prefix(text: Column, k: int, least: float, common: DataFrame, may_meet=None) -> Column:
    """(size, keys, pos) of whole texts: the size of the shingle set and its prefix, rare shingles first, then by hash.

    common has (key, n) for shingles that are to come late, rising by n. Wordless texts share the key 0. pos counts the
    keys from 0; with may_meet, a bitmap of SHARED_BITS, only keys whose upper 32 bits are in it are given.
    """
    rows = sorted((r["key"], r["n"]) for r in common.collect())
    shared = common.sparkSession.sparkContext.broadcast((np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64)))

    @F.arrow_udf("struct<size:int, keys:array<long>, pos:array<int>>")
    def prefixes(texts: pa.Array) -> pa.Array:
        trim_memory()
        known, seen = shared.value
        sizes, keys, places = [], [], []
        for t in texts:
            own = shingle_hashes(t.as_py(), k)
            sizes.append(len(own))
            if len(own) and len(known):
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                own = own[np.argsort(np.where(known[at] == own, seen[at], 0), kind="stable")]
            own = own[: prefix_length(len(own), least)] if len(own) else np.zeros(1, dtype=np.int64)
            pos = np.arange(len(own), dtype=np.int32)
            if may_meet is not None:
                pos = pos[held_bits(may_meet.value, (own >> 32) & (SHARED_BITS - 1))]
            keys.append(own[pos])
            places.append(pos)
        arrays = [pa.array(sizes, type=pa.int32()), pa.array(keys, type=pa.list_(pa.int64())), pa.array(places, type=pa.list_(pa.int32()))]
        return pa.StructArray.from_arrays(arrays, names=["size", "keys", "pos"])

    return prefixes(text)


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sorted arrays of distinct numbers; 1 for two empty ones."""

    @F.arrow_udf("double")
    def jaccard(left: pa.Array, right: pa.Array) -> pa.Array:
        trim_memory()
        out = []
        for x, y in zip(left, right, strict=True):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0)
        return pa.array(out, type=pa.float64())

    return jaccard(a, b)


def histogram(sets: Column) -> Column:
    """How many numbers of each array fall in each class, as 8-bit counts; a full count stands for any number.

    There are half as many classes as numbers, rounded up to a power of two, so counts stay small however long a text is,
    and a histogram takes a sixteenth of its set. Classes are the low bits of a number.
    """

    @F.arrow_udf("binary")
    def bars(arrays: pa.Array) -> pa.Array:
        return pa.array([_bars(x.values.to_numpy()) for x in arrays], type=pa.binary())

    return bars(sets)


def _bars(numbers: np.ndarray) -> bytes:
    classes = 1 << max(6, (len(numbers) // 2).bit_length())
    counts = np.bincount(numbers & (classes - 1), minlength=classes)
    return np.minimum(counts, FULL).astype(np.uint8).tobytes()


def text_histogram(text: Column, k: int) -> Column:
    """(n, bars) of whole texts: the size of the shingle set and its histogram; the set itself stays in the worker."""

    @F.arrow_udf("struct<n:int, bars:binary>")
    def shown(texts: pa.Array) -> pa.Array:
        trim_memory()
        sizes, bars = [], []
        for t in texts:
            own = shingle_hashes(t.as_py(), k)
            sizes.append(len(own))
            bars.append(_bars(own))
        return pa.StructArray.from_arrays([pa.array(sizes, type=pa.int32()), pa.array(bars, type=pa.binary())], names=["n", "bars"])

    return shown(text)


def _shared_at_most(x: bytes, y: bytes) -> float:
    """The sum of the lower counts; the longer histogram is folded to the classes of the shorter one."""
    x, y = (np.frombuffer(side, dtype=np.uint8) for side in (x, y))
    if max(x.max(), y.max()) == FULL:
        return float("inf")
    classes = min(len(x), len(y))
    x, y = (side.reshape(-1, classes).sum(0, dtype=np.int64) for side in (x, y))
    return float(np.minimum(x, y).sum())


def may_share(a: Column, b: Column) -> Column:
    """The most numbers that two sets of such histograms can have in common."""

    @F.arrow_udf("double")
    def most(left: pa.Array, right: pa.Array) -> pa.Array:
        trim_memory()
        return pa.array([_shared_at_most(x.as_py(), y.as_py()) for x, y in zip(left, right, strict=True)], type=pa.float64())

    return most(a, b)


def _flipped(column: str, flip: str) -> Column:
    """The column with the bit at the place `flip` turned; unchanged where that is BITS."""
    return F.expr(f"{column} ^ if({flip} = {BITS}, 0L, shiftleft(1L, cast({flip} as int)))")


def candidates(prints: DataFrame, key: str, fps: str) -> DataFrame:
    """(a, b, early), a > b: keys whose fingerprints in any one table differ in 2 bits or fewer, by balls of radius 1.

    Keys with equal fingerprints of a table are paired with the smallest and the largest of them; the smallest stands
    for the fingerprint, so a bucket holds at most BITS + 1 keys, however many there are in all, and every pair of a
    bucket is given. Early are the pairs with the bucket's first member or with one of the EARLY members before.
    """
    flat = prints.select(key, F.posexplode(fps).alias("t", "fp")).select(
        F.col(key).alias("id"), F.expr("fp | shiftleft(cast(t as long), 56)").alias("fp")
    )
    firsts = stored(flat.groupBy("fp").agg(F.min("id").alias("first"), F.max("id").alias("last")), "simhash-firsts")
    shared = firsts.where("first != last")
    same = flat.join(shared, "fp").select(F.col("id").alias("a"), F.explode(F.array("first", "last")).alias("b"), F.lit(True).alias("early"))
    # a row of a ball is its variant and the place of the flip (BITS: none), which give the fingerprint back
    balls = firsts.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS))).alias("flip")).select(
        _flipped("fp", "flip").alias("variant"), F.col("flip").cast("byte").alias("flip")
    )
    before = F.collect_list("flip").over(Window.partitionBy("variant").orderBy("flip").rowsBetween(-BITS, -1))
    met = balls.select("variant", "flip", before.alias("before")).where("size(before) > 0")
    early = (F.col("at") == F.col("n") - 1) | (F.col("at") < EARLY)
    fp_pairs = (
        met.select("variant", "flip", F.size("before").alias("n"), F.posexplode(F.reverse("before")).alias("at", "other"))
        .select(_flipped("variant", "flip").alias("x"), _flipped("variant", "other").alias("y"), early.alias("early"))
        .groupBy(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
        .agg(F.max("early").alias("early"))
    )
    for end, name in (("x", "a"), ("y", "b")):
        fp_pairs = fp_pairs.join(firsts.select(F.col("fp").alias(end), F.col("first").alias(name)), end)
    pairs = fp_pairs.select("a", "b", "early")
    both = pairs.union(same).where("a != b")
    return both.groupBy(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).agg(F.max("early").alias("early"))


#: Bits of a fingerprint, and members of a bucket that all others of it are compared with in the first pass.
BITS, EARLY = 40, 2
#: So many times at most members of a bucket meet early ones of other groups, before all pairs of different groups do.
TURNS = 2
#: The count of a histogram that stands for itself and any larger one.
FULL = 255
#: Bits of a set's parity, a power of two.
PARITY_BITS = 512
#: So many ids are broadcast, 8 bytes each.
FEW = 1_000_000
#: Texts from which common shingles are learned, how many of those must have one, and how many are told apart. They set
#: the order of prefixes only: any order gives the same pairs.
COMMON_TEXTS, COMMON_IN, COMMON = 4_000, 3, 100_000
#: Bits of the bitmap of prefix shingles that may be shared: 16 MB.
SHARED_BITS = 1 << 27


def members(docs: DataFrame, k: int, least: float) -> DataFrame:
    """(key, id, size, reach): the prefix shingles that texts share, of each text that has some.

    id is a hash of the text's MD5, size that of its shingle set, and reach the number of shingles from this one on.
    Prefixes are made twice rather than stored: first only 32 bits of each shingle are counted, then those that came
    twice by these bits are written and compared as they are. Both steps are one Python function a task.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.xxhash64(F.md5(text)).alias("id"), text.alias("text"))
    share = max(1, docs.count() // COMMON_TEXTS)
    some = keyed.where(F.pmod("id", F.lit(share)) == 0).dropDuplicates(["id"]).select(F.explode(shingle_set(F.col("text"), k)).alias("key"))
    common = some.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON_IN).orderBy(F.desc("n"), "key").limit(COMMON)
    common = stored(common, "near-common")
    shown = keyed.select(prefix(F.col("text"), k, least, common).alias("p"))
    slots = shown.select(F.explode("p.keys").alias("key")).select(F.shiftright("key", 32).cast("int").alias("slot"))
    # far more slots than the bitmap has bits: what it takes is only the slots that come twice
    twice = stored(slots.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1").select("slot"), "near-twice")
    may_meet = bitmap(twice, F.col("slot").cast("long"), SHARED_BITS)
    shown = keyed.select("id", prefix(F.col("text"), k, least, common, may_meet).alias("p")).select("id", "p.*")
    flat = shown.select("id", "size", F.explode(F.arrays_zip("keys", "pos")).alias("e"))
    likely = stored(
        flat.select(F.col("e.keys").alias("key"), "id", "size", (F.col("size") - F.col("e.pos")).alias("reach")).distinct(), "near-likely"
    )
    discard(common, twice)
    shared = likely.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi").select("key")
    held = stored(likely.join(shared, "key", "left_semi"), "near-members")
    discard(likely)
    return held


def _may(size: Column, reach: Column, other_size: Column, other_reach: Column, least: float) -> Column:
    """Whether two texts can be similar enough if this is the first shingle they share; so are sizes and places bounded."""
    return F.least(reach, other_reach) * (1 + least) + 1e-6 >= least * (size + other_size)


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct()


def early_pairs(held: DataFrame, least: float, groups: DataFrame | None = None, turn: int = 0) -> DataFrame:
    """(a, b): every member of a bucket with EARLY members of it, the first by as many hashes, others each turn.

    With groups (id, root) only the members of other groups than theirs.
    """
    firsts = [F.min_by(F.struct("id", "size", "reach", "root"), F.xxhash64("id", F.lit(turn * EARLY + j))) for j in range(EARLY)]
    if not firsts:
        return _pairs(held.limit(0).withColumn("other", F.col("id")))
    placed = held.withColumn("root", F.col("id")) if groups is None else _placed(held, groups)
    hubs = placed.groupBy("key").agg(F.array_distinct(F.array(*firsts)).alias("hubs"))
    met = placed.join(hubs, "key").select("id", "size", "reach", "root", F.explode("hubs").alias("h"))
    return _pairs(met.where(F.col("root") != F.col("h.root")).where(_may(F.col("size"), F.col("reach"), F.col("h.size"), F.col("h.reach"), least)).withColumn("other", F.col("h.id")))


def _placed(held: DataFrame, groups: DataFrame) -> DataFrame:
    """Members with the root of their group; a text without one is its own."""
    return held.join(groups, "id", "left").select("key", "id", "size", "reach", F.coalesce("root", "id").alias("root"))


def parity(text: Column, k: int) -> Column:
    """Whether an odd number of a text's distinct shingles falls in each of PARITY_BITS classes, as an array of longs.

    A shingle that one of two sets has turns one bit at most, so two sets differ in as many shingles as their parities in
    bits, or in more. The length does not grow with the text; beyond some 1,100 shingles little is told apart.
    """

    @F.arrow_udf("array<long>")
    def bits(texts: pa.Array) -> pa.Array:
        trim_memory()
        out = []
        for t in texts:
            counts = np.bincount(shingle_hashes(t.as_py(), k) & (PARITY_BITS - 1), minlength=PARITY_BITS)
            out.append(np.packbits((counts & 1).astype(np.uint8)).view(np.int64))
        return pa.array(out, type=pa.list_(pa.int64()))

    return bits(text)


def _may_differ(x: str, y: str, least: float) -> Column:
    """Whether the parities of two sets (size, odd) allow them to be similar enough: they may differ in 1 - least of their union."""
    turned = sum((F.bit_count(F.col(f"{x}.odd")[i].bitwiseXOR(F.col(f"{y}.odd")[i])) for i in range(PARITY_BITS // 64)), F.lit(0))
    return turned * (1 + least) <= (1 - least) * (F.col(f"{x}.size") + F.col(f"{y}.size")) + 1e-6


def late_pairs(docs: DataFrame, held: DataFrame, groups: DataFrame, k: int, least: float) -> DataFrame:
    """(a, b): the pairs of a bucket whose ends are in different groups (id, root); a text without one is its own. Stored.

    Pairs within the largest group of a bucket are never made: the others' members meet all members. Of those, only
    pairs whose parities allow them to be similar come out of the join, so what follows does not grow with the square
    of a bucket of unlike texts; none that is similar enough is lost.
    """
    placed = stored(_placed(held, groups), "near-placed")
    counts = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    mixed_rows = stored(placed.join(main.select("key", "main"), "key"), "near-mixed")
    ids = stored(mixed_rows.select("id").distinct(), "near-mixed-ids")
    odd = stored(_rows_of(docs, ids).select("id", parity(F.col("text"), k).alias("odd")).distinct(), "near-parities")
    # two texts of one id, should that ever be, have two rows here and both are met
    rows = mixed_rows.join(odd, "id")
    may = _may(*(F.col(f"{s}.{c}") for s in "xy" for c in ("size", "reach")), least) & _may_differ("x", "y", least)
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & may
    both = rows.where("root != main").alias("x").join(rows.alias("y"), met)
    pairs = stored(_pairs(both.select(F.col("x.id").alias("id"), F.col("y.id").alias("other"))), "near-pairs")
    discard(placed, mixed_rows, ids, odd)
    return pairs


def joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after the links (u, v) are added to the groups (node, root)."""
    ends = links
    for end in ("u", "v"):
        ends = ends.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"r{end}")), end, "left")
        ends = ends.withColumn(end, F.coalesce(f"r{end}", end)).drop(f"r{end}")
    over = stored(components(ends, "u", "v", "near-step"), "near-over")
    moved = roots.join(over.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    new = over.join(roots.select("node"), "node", "left_anti").select("node", "root")
    return moved.select("node", F.coalesce("top", "root").alias("root")).union(new)


def _rows_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text_key, text) of the rows whose text has one of these ids, a stored table. Up to FEW are broadcast; more are
    joined behind the sieve, which lets their texts through where the table is read."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.xxhash64(F.md5(text)).alias("id"), F.md5(text).alias("text_key"), text.alias("text"))
    if ids.count() < FEW:
        return keyed.join(F.broadcast(ids), "id", "left_semi")
    hit = sieve(ids, F.col("id"))
    return keyed.where(hit(F.col("id"))).join(ids, "id", "left_semi")


def similar_pairs(docs: DataFrame, pairs: DataFrame, k: int, least: float) -> DataFrame:
    """(u, v): MD5s of the pairs (a, b) of text ids whose shingle sets are similar enough.

    Sets are made of the texts that stand in a pair, once each.
    Pairs first meet with histograms of their sets, which bound what two sets can share from above; whole sets travel
    only with the pairs that stay.
    """

    def of_ends(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        ends = stored(rows.select(F.explode(F.array("a", "b")).alias("id")).distinct(), name)
        return ends, _rows_of(docs, ends)

    ends, rows = of_ends(pairs, "near-ends")
    shown = rows.select("id", "text_key", text_histogram(F.col("text"), k).alias("h"))
    bars = stored(shown.select("id", "text_key", "h.n", "h.bars").dropDuplicates(["id", "text_key"]), "near-bars")
    one, other = (bars.select(F.col("id").alias(end), F.struct("n", "bars").alias(f"h{end}")) for end in "ab")
    may = may_share(F.col("ha.bars"), F.col("hb.bars")) * (1 + least) + 1e-6 >= least * (F.col("ha.n") + F.col("hb.n"))
    likely = stored(pairs.join(one, "a").join(other, "b").where(may).select("a", "b"), "near-likely-pairs")
    discard(ends, bars)
    ends, rows = of_ends(likely, "near-likely-ends")
    copies = rows.groupBy("id", "text_key").agg(F.min("text").alias("text"))
    sets = stored(copies.select("id", "text_key", shingle_set(F.col("text"), k).alias("set")), "near-sets")
    left = sets.select(F.col("id").alias("a"), F.col("text_key").alias("u"), F.col("set").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("text_key").alias("v"), F.col("set").alias("y"))
    met = stored(likely.join(left, "a").join(right, "b").where(similarity(F.col("x"), F.col("y")) >= least).select("u", "v"), "near-similar")
    discard(likely)
    discard(ends, sets)
    return met


def print_pairs(docs: DataFrame) -> DataFrame:
    """(a, b): text ids that the method links, by 64-bit fingerprints that differ in 3 bits or fewer.

    Texts of one fingerprint are paired with the one of them that stands for it, and those that stand for linked
    fingerprints with each other, so the pairs join what the links do. They are proposals; whole sets decide.
    """
    text = F.coalesce("text", F.lit(""))
    prints = stored(
        docs.select(F.xxhash64(F.md5(text)).alias("id"), fingerprint(F.col("text"))[0].alias("fp")).distinct(), "near-prints"
    )
    firsts = stored(prints.groupBy("fp").agg(F.min("id").alias("first"), F.max("id").alias("last")), "near-firsts")
    same = prints.join(firsts.where("first != last"), "fp").where("id != first").select("id", F.col("first").alias("other"))
    ends = firsts.select("fp", "first")
    across = near_links(firsts)
    for end, name in (("a", "id"), ("b", "other")):
        across = across.join(ends.select(F.col("fp").alias(end), F.col("first").alias(name)), end)
    pairs = stored(_pairs(same.union(across.select("id", "other"))), "near-print-pairs")
    discard(prints, firsts)
    return pairs


def near_groups(docs: DataFrame, k: int = 5, least: float = 0.8) -> DataFrame:
    """(text_key, doc_id, rows, keeper_key, keeper_id) of every text that has copies or near copies.

    text_key is the text's MD5, doc_id its smallest doc_id, rows its number of rows. Texts are near copies where their
    sets of k-word shingles have a Jaccard similarity of at least `least`; groups are what such links connect, and the
    keeper is the text with the smallest doc_id (then key). SimHash proposes pairs first, and the sets decide. For the
    near copies whose fingerprints lie apart a prefix filter follows: every pair that is similar enough shares a shingle
    of both prefixes, so none is missed. Early pairs are compared first, in TURNS more turns those of different groups;
    of the others those whose ends are not in one group by then, which changes no group. Null counts as the empty text.
    """
    text = F.coalesce("text", F.lit(""))
    unique = stored(
        docs.select("doc_id", F.md5(text).alias("text_key")).groupBy("text_key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows")), "near-unique"
    )
    proposed = print_pairs(docs)
    held = members(docs, k, least)
    early = stored(early_pairs(held, least).union(proposed).distinct(), "near-early")
    discard(proposed)
    roots = stored(components(similar_pairs(docs, early, k, least), "u", "v", "near-step"), "near-roots")
    discard(early)
    for turn in range(1, TURNS + 2):
        of = roots.select(F.xxhash64("node").alias("id"), F.xxhash64("root").alias("root"))
        last = turn > TURNS
        pairs = late_pairs(docs, held, of, k, least) if last else stored(early_pairs(held, least, of, turn), "near-pairs")
        found = stored(similar_pairs(docs, pairs, k, least), "near-late")
        discard(pairs)
        roots = stored(joined_roots(roots, found), "near-all-roots")
    discard(held)
    grouped = unique.join(roots.withColumnRenamed("node", "text_key"), "text_key", "left").where("root is not null or rows > 1")
    grouped = grouped.select("text_key", "doc_id", "rows", F.coalesce("root", "text_key").alias("root"))
    keepers = grouped.groupBy("root").agg(
        F.min_by(F.struct("text_key", "doc_id"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("k")
    )
    return grouped.join(keepers, "root").select(
        "text_key", "doc_id", "rows", F.col("k.text_key").alias("keeper_key"), F.col("k.doc_id").alias("keeper_id")
    )


def deduplicated(docs: DataFrame, k: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of documents without copies and near copies: of each group one row stays, that of the smallest doc_id.

    Of repeated rows of the keeper one stays, too. All columns are kept. Null and wordless texts are copies of each
    other. Rows that belong to no group, nearly all, pass without a shuffle; only rows that the sieve stops are joined.
    """
    return guarded(docs, lambda d: _deduplicated(d, k, least))


def _deduplicated(docs: DataFrame, k: int, least: float) -> DataFrame:
    groups = stored(near_groups(docs, k, least), "near-groups")
    keepers = groups.where("text_key = keeper_key").select(F.col("text_key").alias("__key"), F.col("keeper_id").alias("__id"))
    hit = sieve(groups, F.xxhash64("text_key"))
    own = docs.columns
    keyed = docs.withColumn("__key", F.md5(F.coalesce("text", F.lit(""))))
    tested = keyed.withColumn("__hit", hit(F.xxhash64("__key")))
    touched = tested.where("__hit")
    alone = touched.join(groups.select(F.col("text_key").alias("__key")), "__key", "left_anti").select(*own)
    first = touched.alias("d").join(
        keepers.alias("k"), (F.col("d.__key") == F.col("k.__key")) & F.col("d.doc_id").eqNullSafe(F.col("k.__id")), "left_semi"
    )
    return tested.where("not __hit").select(*own).union(alone).union(first.dropDuplicates(["__key", "doc_id"]).select(*own))
