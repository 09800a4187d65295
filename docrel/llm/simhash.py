"""SimHash near-duplicates, found through the anchors of a covering code.

Fingerprints of 64 bits that differ in at most 3 bits differ in at most 1 bit of their left or of their right half.
For a half, anchors are the words of a code of 32 bits that covers all words within radius 1: the Hamming code of
length 31 beside one free bit. Of two halves that differ in one bit, some anchor lies within 1 of the first, and so
within 2 of both: each half is replicated to every anchor within radius 2 (17 at most) and compared per anchor.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docrel.llm.shared import checkpointed, connected_components, free_shuffles

WORDS, DISTANCE = 3, 3
#: Covering radius of the code and bits by which one half may differ.
RADIUS, HALF_DISTANCE = 1, DISTANCE // 2


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint, signed as a long. Null texts and texts without words have 0."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: ASCII letters and blanks only
    if not found:
        return 0
    joined, hashed = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        hashes = [hashed(joined, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in found]) - 1
        starts = np.concatenate([[0], ends[: len(found) - words] + 1]).tolist()
        view = memoryview(joined)
        hashes = [hashed(view[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]
    return majority(np.array(hashes, "<u8"))


def majority(hashes: np.ndarray) -> int:
    """The long, signed, whose bits are 1 where over half of the 64-bit ``hashes`` have a 1."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = np.ascontiguousarray(hashes[i : i + 65536]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text, words: int = WORDS):
    """Column: the fingerprint of a text."""

    @F.pandas_udf("long")
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return each(text)


def anchors(half: np.ndarray) -> np.ndarray:
    """Anchors within radius 2 of each 32-bit word, as rows; -1 fills rows of fewer.

    Bit 31 is free; bits 0 to 30 stand for positions 1 to 31. The syndrome of a word is the exclusive or of the
    positions of its ones; it is 0 for anchors, else the position whose flip gives the one anchor at distance 1.
    Flips of two positions give an anchor if the exclusive or of the two is the syndrome.
    """
    low, syndrome = half & 0x7FFFFFFF, np.zeros(len(half), np.int64)
    for p in range(1, 32):
        syndrome ^= np.where(low >> (p - 1) & 1, p, 0)
    inside = syndrome == 0
    flip = np.where(inside, 0, np.int64(1) << np.maximum(syndrome - 1, 0))
    out = [half ^ flip, half ^ flip ^ (np.int64(1) << 31)]
    for p in range(1, 32):
        q = p ^ syndrome
        out.append(np.where((q > p) & ~inside, half ^ (np.int64(1) << (p - 1)) ^ (np.int64(1) << np.maximum(q - 1, 0)), -1))
    return np.stack(out, axis=1)


def all_anchors(prints):
    """Column: anchors of both halves of fingerprints; those of the right half have bit 32 set."""

    @F.pandas_udf("array<long>")
    def each(prints: pd.Series) -> pd.Series:
        whole = prints.to_numpy(np.int64)
        left, right = anchors(whole >> 32 & 0xFFFFFFFF), anchors(whole & 0xFFFFFFFF)
        both = np.concatenate([left, np.where(right < 0, -1, right | np.int64(1) << 32)], axis=1)
        return pd.Series([row[row >= 0] for row in both])

    return each(prints)


def near_prints(prints: DataFrame) -> DataFrame:
    """``(u, v)`` distinct links of the distinct longs ``fp`` that differ in at most 3 bits."""
    spots = prints.select("fp", F.explode(all_anchors(F.col("fp"))).alias("anchor"))
    a, b = spots.withColumnRenamed("fp", "u"), spots.withColumnRenamed("fp", "v")
    return a.join(b, "anchor").where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE)).select("u", "v").distinct()


def components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp, component_id`` of every row: documents whose fingerprints link have the smallest key reachable.

    Copies have one fingerprint and are one node. Null and empty texts have fingerprint 0 and link like others. Null
    keys count only where a component has no other. Rows repeat as they do in ``docs``. The table of components that
    rows meet has one row for each fingerprint, so a fingerprint that a third of the rows share is split.
    """
    rows = checkpointed(docs.select(F.col(key).alias("key"), fingerprints(F.col(text)).alias("fp")))
    return rows.join(_component_table(rows), "fp", "left").select(F.col("key").alias(key), "fp", "component_id")


def _component_table(rows: DataFrame) -> DataFrame:
    """``fp, component_id`` of each fingerprint of ``key, fp``."""
    prints = checkpointed(rows.groupBy("fp").agg(F.min("key").alias("least")))
    parts = connected_components(near_prints(prints))
    known = checkpointed(prints.join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left")
                         .withColumn("component", F.coalesce("component", "fp")))
    least = checkpointed(known.groupBy("component").agg(F.min("least").alias("component_id")))
    return checkpointed(known.join(least, "component").select("fp", "component_id"))


# --- similarity of shingle sets ------------------------------------------------------------------------------------------

#: Words of a shingle and least Jaccard similarity of two texts' sets of shingles.
SET_WORDS, SIMILARITY = 5, 0.8
#: First shingles of a prefix by which sets first meet one leader only.
LEADERS = 24
#: Sets that a list draws in the first round, times as many in each further one, and sets for each drawn one that a list needs.
DRAWN, MORE, CROWD = 2, 4, 8
#: Lists before one in which a pair that meets there may have met; further ones cost more than the repeated pairs.
BEFORE = 8
#: Longs, of 64 bits each, of the parity map of a small set; larger sets have maps of twice, four times... as many.
MARKS, MARKED = 16, 256
#: Texts sampled for shingles that many texts share, which go last in the order of prefixes; most such shingles.
SAMPLE, FREQUENT = 5_000, 50_000
#: Hashes of candidates and of dropped rows are broadcast up to so many rows of two longs; beyond, they are joined.
BROADCAST_ROWS = 500_000


def shingle_set(text: str | None, words: int = SET_WORDS) -> np.ndarray:
    """Sorted distinct hashes (signed) of a text's shingles; words as in ``fingerprint``. Empty for a text without words."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.zeros(0, np.int64)
    joined, hashed = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([hashed(joined, 42)], "<u8").view(np.int64)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[: len(found) - words] + 1]).tolist()
    view = memoryview(joined)
    return np.unique(np.fromiter((hashed(view[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)), "<u8", len(starts)).view(np.int64))


def prefix_of(hashes: np.ndarray, known: np.ndarray, ranks: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles of which two similar sets share one at least: the first in an order that all sets have in common.

    Of n shingles a similar set shares ``similarity`` n at least, and so one of any n - ceil(similarity n) + 1. Shingles
    in ``known`` (sorted) come last, by their ``ranks``, the others by hash; the order decides the cost, not the result.
    """
    n = len(hashes)
    rank = np.zeros(n, np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        rank = np.where(known[at] == hashes, ranks[at], 0)
    return hashes[np.lexsort((hashes, rank))[: n - int(np.ceil(similarity * n - 1e-9)) + 1]]


def parity_map(hashes: np.ndarray) -> np.ndarray:
    """Bit i says whether an odd number of hashes is i modulo the bits of the map, four or more for each hash.

    Maps of two sets differ in no more bits than there are elements in one set alone, so they bound the similarity. The
    exclusive or of the halves of a map is the map of half its length.
    """
    bits, held = 64 * MARKS, MARKED
    while held < len(hashes):
        bits, held = bits * 2, held * 2
    odd = np.bincount(hashes & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def bits_apart(a, b):
    """Column: bits by which two parity maps differ; the longer one, of twice the length at most, is halved."""

    def halved(x, y):
        n = F.size(y)
        return F.when(F.size(x) > n, F.zip_with(F.slice(x, F.lit(1), n), F.slice(x, n + 1, n), lambda p, q: p.bitwiseXOR(q))).otherwise(x)

    differ = F.zip_with(halved(a, b), halved(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(differ, F.lit(0), lambda total, x: total + x)


def _frequent(docs: DataFrame, text: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of some 5,000 texts hold, sorted, and their ranks, the most common last."""
    share = min(1.0, SAMPLE / max(1, docs.count()))
    some = docs.where(F.pmod(F.xxhash64(text), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select(text).distinct()
    counted = some.select(F.explode(_sets(F.col(text), words)).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = counted.orderBy(F.desc("n"), "s").limit(FREQUENT).collect()
    known = np.array([r.s for r in found], np.int64)
    order = np.argsort(known)
    return known[order], np.arange(len(found), 0, -1, dtype=np.int64)[order]


def _set_prefixes(text: str, words: int, similarity: float, shared):
    """Column: ``sid`` (which stands for the set of shingles; 0 for none), its size ``n``, its SimHash ``fp``, its
    ``marks`` and its ``prefix``."""

    @F.pandas_udf("sid long, n int, fp long, marks array<long>, prefix array<long>")
    def each(texts: pd.Series) -> pd.DataFrame:
        sid, n, fp = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int32), np.zeros(len(texts), np.int64)
        marks, prefix = [], []
        for i, t in enumerate(texts):
            hashes = shingle_set(t, words)
            if len(hashes):
                sid[i], n[i] = np.array([xxhash.xxh64_intdigest(hashes.tobytes())], "<u8").view(np.int64)[0], len(hashes)
                fp[i] = majority(hashes)
            marks.append(parity_map(hashes))
            prefix.append(prefix_of(hashes, *shared.value, similarity) if len(hashes) else hashes)
        return pd.DataFrame({"sid": sid, "n": n, "fp": fp, "marks": marks, "prefix": prefix})

    return each(F.col(text))


def _sets(text, words: int):
    @F.pandas_udf("array<long>")
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, words) for t in texts])

    return each(text)


def _few(df: DataFrame) -> DataFrame:
    """A checkpointed table of longs with a hint for the broadcast if it is counted to be small enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def anchor_pairs(classes: DataFrame) -> DataFrame:
    """``(u, v)`` of ``sid, fp``: sets whose SimHashes are equal or, at an anchor, differ from its first in 3 bits at most.

    Anchors as for ``near_prints``; one leader an anchor makes a large group of near copies one component without its pairs.
    """
    prints = checkpointed(classes.groupBy("fp").agg(F.min("sid").alias("head")))
    equal = classes.join(prints, "fp").where("sid > head").select(F.col("head").alias("u"), F.col("sid").alias("v"))
    spots = prints.select("fp", F.explode(all_anchors(F.col("fp"))).alias("anchor"))
    leaders = spots.groupBy("anchor").agg(F.min("fp").alias("first"), F.max("fp").alias("last")).where("first < last").select("anchor", "first")
    met = spots.join(leaders, "anchor").where((F.col("fp") != F.col("first")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("first"))) <= DISTANCE))
    near = met.select("fp", "first").distinct()
    heads = near.join(prints, "fp").select("first", F.col("head").alias("a")).join(prints.select(F.col("fp").alias("first"), F.col("head").alias("b")), "first")
    return equal.union(heads.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")))


def similar_sets(docs: DataFrame, rows: DataFrame, text: str, hashed, words: int, similarity: float) -> DataFrame:
    """Links ``(u, v)`` between the ``sid`` of texts whose components are those of all pairs of similar sets.

    SimHashes meet at anchors. That alone misses most pairs at the least similarity, so sets also meet by each shingle of
    their prefixes that another set has too, where no similar pair is missed: first only with the smallest set that has
    it, which makes large groups of near copies components without all their pairs, then, where many share it, with
    a few that are drawn for each shingle, more in each round, as the smallest may be similar to few of a group, then
    all, but for those of one component, which would change nothing. Shingles that the same sets hold count once, and a pair that met in one of
    the few lists that both sides had just before is not made again: its first meeting is always made, as all sets have
    their shingles in one order. Parity maps and whole sets decide.
    """
    classes = checkpointed(rows.where("sid <> 0").groupBy("sid").agg(*[F.min(c).alias(c) for c in ("hash", "n", "fp")], F.first("marks").alias("marks")))
    decide = lambda near: checkpointed(_verified(docs, classes, near, text, hashed, words, similarity))
    met = checkpointed(_shared_shingles(rows))
    free_shuffles(docs.sparkSession)

    sized = F.least("un", "vn") >= similarity * F.greatest("un", "vn") - 1e-9
    early = met.where(F.col("at") < LEADERS)
    leaders = early.groupBy("shingle").agg(F.min(F.struct("sid", "n")).alias("v")).select("shingle", F.col("v.sid").alias("v"), F.col("v.n").alias("vn"))
    led = early.select("shingle", F.col("sid").alias("u"), F.col("n").alias("un")).join(leaders, "shingle").where("u <> v").where(sized)
    first = decide(anchor_pairs(classes).union(led.select(F.least("u", "v"), F.greatest("u", "v"))).distinct())

    named = _named(met, first)
    free_shuffles(docs.sparkSession)
    # pairs of components come before pairs of texts: the pairs within a large one are never made
    lists = _lists(named)
    spans = named.join(lists, "shingle").groupBy("list", "sid").agg(*[F.min(c).alias(c) for c in ("component", "n", "at")])
    order = Window.partitionBy("sid").orderBy("at")
    open_ = checkpointed(spans.withColumns({f"p{i}": F.lag("list", i).over(order) for i in range(1, BEFORE + 1)}))
    shares = similarity / (1 + similarity)
    # by its first common shingle a pair shares no more than what follows on either side
    most = F.least("urest", "vrest") >= shares * (F.col("un") + F.col("vn")) - 1e-6
    links = first
    draws = DRAWN
    while not (crowded := _crowded(open_, draws)).isEmpty():
        drawn = _drawn(open_, crowded, draws).where(sized & most)
        more = decide(checkpointed(drawn.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()))
        if not more.isEmpty():
            links = checkpointed(links.union(more))
            open_ = _named(open_.drop("component"), links)
        free_shuffles(docs.sparkSession)
        draws *= MORE
    # what all members of a component that are in a list met before
    alike = [F.when((F.count(p) == F.count(F.lit(1))) & (F.min(p) == F.max(p)), F.min(p)) for p in (f"p{i}" for i in range(1, BEFORE + 1))]
    groups = checkpointed(open_.groupBy("list", "component").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("at")).alias("rest"), F.array_compact(F.array(*alike)).alias("before")))
    a, b = (groups.select("list", *[F.col(c).alias(f"{x}{c}") for c in groups.columns[1:]]) for x in "uv")
    fit = ((F.col("umost") >= similarity * F.col("vleast") - 1e-9) & (F.col("vmost") >= similarity * F.col("uleast") - 1e-9)
           & (F.least("urest", "vrest") >= shares * (F.col("uleast") + F.col("vleast")) - 1e-6))
    new = ~F.arrays_overlap("ubefore", "vbefore")
    sides = a.join(b, "list").where((F.col("ucomponent") < F.col("vcomponent")) & fit & new).select(
        "list", "ucomponent", "vcomponent", "vleast", "vmost", "vrest", "vbefore")
    before = F.array_compact(F.array(*[F.col(f"p{i}") for i in range(1, BEFORE + 1)]))
    u, v = (open_.select("list", F.col("component").alias(f"{x}component"), F.col("sid").alias(x), F.col("n").alias(f"{x}n"),
                         (F.col("n") - F.col("at")).alias(f"{x}rest"), before.alias(f"{x}before")) for x in "uv")
    # a set of one side that cannot be similar to any of the other, or met all of them before, goes before pairs are made
    one = ((F.col("vmost") >= similarity * F.col("un") - 1e-9) & (F.col("un") >= similarity * F.col("vleast") - 1e-9)
           & (F.least("urest", "vrest") >= shares * (F.col("un") + F.col("vleast")) - 1e-6))
    open_sides = sides.join(u, ["list", "ucomponent"]).where(one & new).drop("vleast", "vmost", "vrest", "vbefore")
    pairs = open_sides.join(v, ["list", "vcomponent"]).where(sized & most & new)
    second = decide(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    return links.union(second)


def _shared_shingles(rows: DataFrame) -> DataFrame:
    """``shingle, sid, n, at`` of the shingles of prefixes that several sets have; copies have one set, which counts once.

    The rows are dealt out by shingle once, whatever their number.
    """
    spots = rows.where("sid <> 0").select("sid", "n", F.posexplode("prefix").alias("at", "shingle"))
    own = Window.partitionBy("shingle")
    shared = spots.withColumns({"a": F.min("sid").over(own), "b": F.max("sid").over(own)}).where("a < b")
    return shared.groupBy("shingle", "sid").agg(F.min("n").alias("n"), F.min("at").alias("at"))


def _named(sets: DataFrame, links: DataFrame) -> DataFrame:
    """``sets`` with the ``component`` of each ``sid`` by ``links``."""
    parts = connected_components(links).select(F.col("node").alias("sid"), "component")
    return checkpointed(sets.join(parts, "sid", "left").withColumn("component", F.coalesce("component", "sid")))


def _crowded(open_: DataFrame, draws: int) -> DataFrame:
    """``list, size`` of the lists of several components that hold ``CROWD`` sets or more for each of ``draws``."""
    sizes = open_.groupBy("list").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("a"), F.max("component").alias("b"))
    return checkpointed(sizes.where((F.col("size") >= CROWD * draws) & (F.col("a") < F.col("b"))).select("list", "size"))


def _drawn(open_: DataFrame, crowded: DataFrame, draws: int) -> DataFrame:
    """``u, un, urest, v, vn, vrest``: sets of crowded lists, each beside those some ``draws`` of its list that the hash of
    set and list draws, if of another component. Of all pairs of a list these are a quarter at most, by and large."""
    own = open_.select("list", "component", "sid", "n", (F.col("n") - F.col("at")).alias("rest"))
    heads = own.join(crowded, "list").where(F.pmod(F.xxhash64("sid", "list", F.lit(draws)), F.col("size")) < draws)
    u, v = (x.select("list", F.col("component").alias(f"{y}component"), F.col("sid").alias(y), F.col("n").alias(f"{y}n"), F.col("rest").alias(f"{y}rest"))
            for x, y in ((own, "u"), (heads, "v")))
    return u.join(v, "list").where("ucomponent <> vcomponent")


def _lists(named: DataFrame) -> DataFrame:
    """``shingle, list`` of the shingles that several components hold; those that the same sets hold have one ``list``.

    Lists compare by their length and two 64-bit hashes of what they hold.
    """
    own = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("sid")), F.bit_xor(F.xxhash64("sid", F.lit(1)))).alias("holds")
    lists = checkpointed(named.groupBy("shingle").agg(F.min("component").alias("a"), F.max("component").alias("b"), own).where("a < b").select("shingle", "holds"))
    return lists.join(lists.groupBy("holds").agg(F.min("shingle").alias("list")), "holds").select("shingle", "list")


def _verified(docs: DataFrame, classes: DataFrame, near: DataFrame, text: str, hashed, words: int, similarity: float) -> DataFrame:
    """The pairs of ``near`` whose whole sets are similar.

    Parity maps leave out pairs that cannot be; only texts of the others give sets, one text for each class.
    """
    left, right = (classes.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), F.col("marks").alias(f"marks{x}")) for x in "uv")
    both, share = F.col("nu") + F.col("nv"), similarity / (1 + similarity)
    sized = F.least("nu", "nv") >= similarity * F.greatest("nu", "nv") - 1e-9
    # sizes first: maps of sets that are similar in size have the same length or twice that
    may = F.when(sized, bits_apart(F.col("marksu"), F.col("marksv")) <= both - 2 * F.ceil(share * both - 1e-6))
    near = checkpointed(near.join(left, "u").join(right, "v").where(may).select("u", "v"))
    free_shuffles(docs.sparkSession)
    nodes = near.select(F.explode(F.array("u", "v")).alias("sid")).distinct()
    chosen = checkpointed(classes.join(nodes, "sid").select(F.col("hash").alias("__hash"), F.col("sid").alias("__sid")))
    met = docs.select(hashed.alias("__hash"), F.col(text).alias("__text")).join(_few(chosen), "__hash")
    # rows that repeat a text give its set several times; either side of the join reads the one exchange that this makes
    sets = met.select("__sid", _sets(F.col("__text"), words).alias("__set")).dropDuplicates(["__sid"])
    left, right = (sets.select(F.col("__sid").alias(n), F.col("__set").alias(f"set_{n}"), F.size("__set").alias(f"n_{n}")) for n in "uv")
    shared = F.size(F.array_intersect("set_u", "set_v"))
    return near.join(left, "u").join(right, "v").where(shared >= similarity * (F.col("n_u") + F.col("n_v") - shared)).select("u", "v")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SET_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of similar texts, with all columns of ``docs``: that with the smallest key.

    Texts link if their sets of word shingles have a Jaccard similarity of ``similarity`` or more; a group is what links
    reach. Null and empty texts are equal. Of rows that repeat the smallest key, or where a group has null keys only, the
    one with the smallest hash of key and text stays (of wholly equal rows any one). What goes is found on keys and
    hashes; rows that stay leave by an anti-join with it. An empty table gives no rows. Columns may have any names.
    """
    hashed = F.xxhash64(F.col(key), F.col(text))
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, text, words))
    found = docs.select(F.col(key).alias("key"), _set_prefixes(text, words, similarity, shared).alias("p"), hashed.alias("hash"))
    rows = checkpointed(found.select("key", "hash", "p.*"))
    shared.destroy()
    parts = connected_components(similar_sets(docs, rows, text, hashed, words, similarity))
    classes = checkpointed(rows.groupBy("sid").agg(F.min("key").alias("least")).join(parts.select(F.col("node").alias("sid"), "component"), "sid", "left")
                           .withColumn("component", F.coalesce("component", "sid")))
    least = classes.groupBy("component").agg(F.min("least").alias("least"))
    placed = checkpointed(rows.select("key", "hash", "sid").join(classes.select("sid", "component").join(least, "component"), "sid"))
    heads = placed.where(F.col("key").eqNullSafe(F.col("least"))).groupBy("component").agg(F.min("hash").alias("head"))
    goes = placed.join(heads, "component").where(~F.col("key").eqNullSafe(F.col("least")) | (F.col("hash") != F.col("head")))
    gone = _few(checkpointed(goes.select(F.col("hash").alias("__hash"), F.col("key").alias("__key")).distinct()))
    own, other = docs.select(F.struct(*docs.columns).alias("row"), hashed.alias("__hash")).alias("own"), gone.alias("other")
    same = (F.col("own.__hash") == F.col("other.__hash")) & F.col(f"own.row.`{key}`").eqNullSafe(F.col("other.__key"))
    kept = own.join(other, same, "left_anti")
    # rows that are wholly equal have one hash
    if placed.count() > placed.select("component", "hash", "key").distinct().count():
        kept = kept.dropDuplicates(["__hash"])
    return kept.select("row.*")
