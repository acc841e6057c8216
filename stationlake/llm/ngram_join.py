"""Exact Jaccard join of documents over word n-grams by vertical partitioning.

The n-grams have one global order, that of their 64-bit hashes, and the order
is cut into fragments.

1. A document's set is cut at size-class dependent fragments. Two sets of at
   most ``u`` n-grams with Jaccard ``t`` differ in at most
   ``h = 2u(1-t)/(1+t)`` n-grams, so of ``h + 1 + spare`` fragments more than
   ``spare`` are equal in both. ``spare`` is more than nearly every set has of
   empty fragments; a set with more offers those too, so that nothing rests on
   chance. From the sizes follows how many fragments a set must share at
   least, and hence how many of its commonest fragments need not be filed (a
   prefix filter over fragments, rarest first). Documents that share a filed
   fragment are candidates.
2. For a candidate pair each fragment of the order counts its part of the
   overlap on its own; the counts are summed per pair and compared with the
   threshold in integers.

Equal sets are one node from the start. The members of a bucket of candidates
are compared with one hub, that which shares most with others (the original of
a group of edited copies), not with each other. Two members that both link
with the hub are in one component anyway. For a member ``u`` that does not,
let ``D(u)`` be its symmetric difference with the hub: as
``|u ^ v| = |D(u) ^ D(v)|``, a link between ``u`` and another member ``v``
needs a number of common elements of ``D(u)`` and ``D(v)`` that their sizes
decide. These are found by a prefix filter over the differences, rarest first
(nearly all of them are edits that no other copy has), and compared as above.
So no link is lost, and a group of copies is never expanded into its pairs.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered. NULL and empty
texts have no set and link with nothing; fewer words than ``n`` are one n-gram.
Nodes are sets of n-grams, so rows may repeat a doc_id, with the same text or
another. A NULL doc_id links with nothing, as it has no id to be named by. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm._common import portions
from stationlake.llm._components import components
from stationlake.session import materialize, materialize_counted, release

CLASS_RATIO = 1.5
COUNT_FRAGMENTS = 8
#: Words whose hashes a task remembers at a time.
WORD_CACHE = 400_000
#: Up to so many ids or keys are broadcast; more are joined by a shuffle.
MAX_BROADCAST_IDS = 1_000_000

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        v = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return v


def ngram_set(text: str | None, n: int, cache: _WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        out = _mix(out * _M1 + h[j : len(h) - size + 1 + j])
    return np.unique(out)


def size_classes(n: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(class, fragments, spare, least) under which a set of ``n`` n-grams is
    filed: its own class, and the next if a partner may be in it. ``least`` is
    the number of equal fragments that it has with any partner."""

    def low(k: int) -> int:
        return int(np.ceil(CLASS_RATIO**k))

    k = 0
    while low(k + 1) <= n:
        k += 1
    out = []
    for c in (k, k + 1):
        if c == k or 100 * n >= percent * low(c):
            top = low(c + 1) - 1
            differ = 2 * top * (100 - percent) // (100 + percent)
            spare = 3
            for _ in range(12):  # empty fragments to expect in a small set of the class, and five deviations
                parts = differ + 1 + spare
                empty = parts * np.exp(-low(c) / parts)
                spare = max(3, int(np.ceil(empty + 5 * np.sqrt(empty))))
            parts = differ + 1 + spare
            partner = min(top, 100 * n // percent)
            out.append((c, parts, spare, parts - (100 - percent) * (n + partner) // (100 + percent)))
    return out


def fragment_keys(grams: np.ndarray, percent: int) -> tuple[np.ndarray, list[int], list[int]]:
    """Hashes of the fragments of a sorted set under each size class (two at
    most), the number of them, and how many of them a partner has at least."""
    keys, number, least = [], [], []
    with np.errstate(over="ignore"):
        for c, parts, spare, equal in size_classes(len(grams), percent):
            # Fragment = position of the hash's high 32 bits in the order's range.
            frag = ((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            first = np.flatnonzero(np.r_[True, frag[1:] != frag[:-1]])
            total = np.add.reduceat(_mix(grams * _M1 + np.uint64(c)), first)
            sizes = np.diff(np.r_[first, len(grams)]).astype(np.uint64)
            tag = np.uint64(c * 1_000_003) + frag[first]
            own = [_mix(_mix(total + _M2 * tag) + sizes)]
            empty = parts - len(first)
            if empty > spare:
                blank = np.setdiff1d(np.arange(parts, dtype=np.uint64), frag[first])
                own.append(_mix(_mix(_M3 * (np.uint64(c * 1_000_003) + blank))))
            keys += own
            number.append(sum(map(len, own)))
            least.append(max(1, equal - min(empty, spare)))
    return np.concatenate(keys), number, least


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def fragments(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Per document: doc_id, hash of its text, n_grams, set key (k1, k2; NULL without words),
    the ``keys`` of its fragments, their ``number`` and ``least`` by size class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _WordHash()
        for b in (part for batch in batches for part in portions(batch)):
            rows = []
            for i, th, text in zip(b["doc_id"], b["th"], b["text"]):
                g = ngram_set(text, n, cache)
                if len(g):
                    keys, number, least = fragment_keys(g, percent)
                    rows.append((i, th, len(g), *_key(g), _signed(keys), number, least))
                else:
                    rows.append((i, th, 0, None, None, None, None, None))
            # As objects: columns with NULLs would pass through floats and lose digits.
            columns = ["doc_id", "th", "n_grams", "k1", "k2", "keys", "number", "least"]
            out = pd.DataFrame(rows, columns=columns, dtype=object)
            yield out.astype({"th": "int64", "n_grams": "int64", "k1": "Int64", "k2": "Int64"})

    rows = docs.select(F.col("doc_id").cast("string"), F.xxhash64("text").alias("th"), "text")
    schema = "doc_id string, th long, n_grams long, k1 long, k2 long, keys array<long>, number array<int>, least array<int>"
    return rows.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def _key(grams: np.ndarray) -> tuple[int, int]:
    k1, k2 = np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), np.int64)
    return int(k1), int(k2)


def segments(nodes: DataFrame, n: int, parts: int) -> DataFrame:
    """Per node (node, k1, k2, text) and fragment of the order: its n-grams there.
    A text whose set is not the node's (its doc_id has several texts) is passed over."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _WordHash()
        limits = np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - (parts.bit_length() - 1))
        for b in (part for batch in batches for part in portions(batch)):
            rows = []
            for node, k1, k2, text in zip(b["node"], b["k1"], b["k2"], b["text"]):
                g = ngram_set(text, n, cache)
                if len(g) and _key(g) == (k1, k2):
                    cut = np.split(g, np.searchsorted(g, limits))
                    rows += [(node, f, len(g), _signed(s)) for f, s in enumerate(cut)]
            yield pd.DataFrame(rows, columns=["node", "frag", "n", "grams"])

    if parts & (parts - 1):
        raise ValueError("the number of fragments must be a power of two")
    return nodes.select("node", "k1", "k2", "text").mapInPandas(run, "node long, frag int, n long, grams array<long>")


def _fragment_pairs(pairs: DataFrame, segs: DataFrame) -> DataFrame:
    """a, b, frag, na, nb and both n-gram lists of a fragment, for pairs (a, b)."""
    a = segs.select(F.col("node").alias("a"), "frag", F.col("n").alias("na"), F.col("grams").alias("ga"))
    b = segs.select(F.col("node").alias("b"), "frag", F.col("n").alias("nb"), F.col("grams").alias("gb"))
    return pairs.join(a, "a").join(b, ["b", "frag"])


def _overlaps(pairs: DataFrame, segs: DataFrame) -> DataFrame:
    """a, b, na, nb, both: the overlap counted per fragment and summed per pair."""
    partial = F.size(F.array_intersect("ga", "gb")).cast("long")
    counted = _fragment_pairs(pairs, segs).groupBy("a", "b")
    return counted.agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum(partial).alias("both"))


def _links(both: Column, total: Column, percent: int) -> Column:
    """Jaccard of at least ``percent``: ``total`` is the sum of the two sizes."""
    return both * 100 >= (total - both) * percent


def _small(df: DataFrame, name: str) -> DataFrame:
    """``df`` written; marked for a broadcast if it has few rows (of ids and keys only)."""
    out, seen = materialize_counted(df, name)
    return F.broadcast(out) if seen["rows"] <= MAX_BROADCAST_IDS else out


def _repeated(filed: DataFrame) -> DataFrame:
    """The rows of ``filed`` without those whose key nobody else has.

    One exchange: rows are range-partitioned on (key, node), so a key that very
    many share is cut over tasks too, and in a sorted partition a lone key differs
    from both neighbours. A partition's first and last keys may go on in the next
    one and are kept; the exact count comes after this, on few rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, first = None, True  # the last row so far waits for its neighbour
        for b in batches:
            if held is not None:
                b = pd.concat([held, b], ignore_index=True)
            if not len(b):
                continue
            key = b["key"].to_numpy()
            same = key[1:] == key[:-1]
            keep = np.r_[first or bool(b["keep"].iloc[0]), same] | np.r_[same, False]
            held = b.iloc[[-1]].assign(keep=bool(keep[-1]))
            yield b[:-1][keep[:-1]].drop(columns="keep")
            first = False
        if held is not None:
            yield held.drop(columns="keep")

    rows = filed.repartitionByRange("key", "node").sortWithinPartitions("key").withColumn("keep", F.lit(False))
    return rows.mapInPandas(run, filed.schema)


def _hub_pairs(filed: DataFrame) -> DataFrame:
    """a (member), b (hub), crowd (some common bucket has a third member)."""
    shared = filed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size"))
    shared = _small(shared.where("low < high").select("key", "size"), "shared-fragments")
    # Rarest first, after those that nobody else has: the last `least - 1` need no filing.
    own = Window.partitionBy("node", "next")
    at = filed.join(shared, "key").withColumn("nth", F.row_number().over(own.orderBy("size", "key")))
    at = at.withColumn("alone", F.col("number") - F.count(F.lit(1)).over(own))
    at = at.where(F.col("alone") + F.col("nth") <= F.col("number") - F.col("least") + 1).select("key", "node")
    at = materialize(at, "filed-fragments")
    shared = at.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = materialize(at.join(shared, "key"), "fragment-buckets")
    release(at)
    score = buckets.groupBy("node").agg(F.sum("size").alias("score"))
    best = F.max(F.struct("score", (-F.col("node")).alias("neg")))
    hubs = buckets.join(score, "node").groupBy("key").agg(best.alias("best"))
    hubs = hubs.select("key", (-F.col("best.neg")).alias("hub"))
    pairs = buckets.join(hubs, "key").where(F.col("node") != F.col("hub"))
    return pairs.groupBy(F.col("node").alias("a"), F.col("hub").alias("b")).agg(F.max(F.col("size") > 2).alias("crowd"))


def _filed(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, key, next (1: filed under the next size class), number, least: the fragments that two nodes or more have."""
    known = sets.where(F.col("k1").isNotNull() & F.col("doc_id").isNotNull())
    copies = known.select("node").join(nodes.select("node"), "node", "left_anti")
    filed = known.select("node", "keys", "number", "least").join(_small(copies, "copies"), "node", "left_anti")
    filed = filed.select("node", "number", "least", F.posexplode("keys").alias("pos", "key"))
    nxt = (F.col("pos") >= F.get("number", F.lit(0))).cast("int")
    # The three small numbers travel as one.
    packed = F.shiftleft(F.get("number", nxt).cast("long"), 32) + F.shiftleft(F.get("least", nxt).cast("long"), 1) + nxt
    rows = _repeated(filed.select("node", "key", packed.alias("p")))
    return rows.select(
        "node",
        "key",
        F.col("p").bitwiseAND(F.lit(1)).cast("int").alias("next"),
        F.shiftright("p", 32).cast("int").alias("number"),
        F.shiftright(F.col("p").bitwiseAND(F.lit((1 << 32) - 1)), 1).cast("int").alias("least"),
    )


def _components(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Per row of ``docs``: doc_id, th (hash of its text), n_grams, ``first`` (smallest doc_id of
    its set), ``component_id``, and ``named`` (its set names the component)."""
    full = fragments(docs, n, percent).withColumn("node", F.monotonically_increasing_id())
    full = materialize(full, "ngram-sets")
    sets = materialize(full.select("doc_id", "th", "n_grams", "k1", "k2", "node"), "ngram-set-keys")
    known = sets.where(F.col("k1").isNotNull() & F.col("doc_id").isNotNull())
    firsts = known.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "node")).alias("r"))
    nodes = materialize(firsts.select("k1", "k2", F.col("r.doc_id").alias("first"), F.col("r.node").alias("node")), "ngram-nodes")

    filed = materialize(_filed(full, nodes), "repeated-fragments")
    release(full)
    pairs, seen = materialize_counted(_hub_pairs(filed), "hub-pairs")
    release(filed)

    named = nodes.select("k1", "k2", "first", F.col("first").alias("component_id"), F.lit(True).alias("named"))
    if seen["rows"]:
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        wanted = _small(nodes.join(wanted, "node", "left_semi"), "candidates")
        texts = docs.select(F.col("doc_id").cast("long").alias("first"), "text").join(wanted, "first")
        segs = segments(texts, n, COUNT_FRAGMENTS)
        if not known.groupBy("doc_id").count().where("count > 1").isEmpty():
            segs = segs.dropDuplicates(["node", "frag"])
        segs = materialize(segs, "candidate-segments")
        comp = materialize(components(_all_links(pairs, segs, percent)), "components")
        release(segs)
        comp = nodes.join(comp, "node").select("node", "component", "first")
        least = comp.groupBy("component").agg(F.min(F.struct("first", "node")).alias("least"))
        comp = comp.join(least, "component").select("node", "least")
        named = nodes.join(comp, "node", "left").select(
            "k1",
            "k2",
            "first",
            F.coalesce("least.first", "first").alias("component_id"),
            F.coalesce(F.col("least.node") == F.col("node"), F.lit(True)).alias("named"),
        )
    return sets.select("doc_id", "th", "n_grams", "k1", "k2").join(named, ["k1", "k2"], "left").drop("k1", "k2")


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``. Two documents
    link at ``100 * intersection >= percent * union``; ``component_id`` is the
    smallest doc_id that links reach."""
    reached = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = _components(docs, n, percent)
    return out.select("doc_id", F.col("n_grams").alias("n_shingles"), reached.alias("component_id"))


#: A family of members that do not link with their hub gets a hub of its own while their
#: differences from it would be joined to more than so many rows each, in so many rounds at most.
FAMILY_ROWS, FAMILY_ROUNDS = 256, 3


def _all_links(pairs: DataFrame, segs: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all links among the members of one bucket;
    ``pairs`` has each member (a) with the hub (b)."""
    links, rounds = None, 0
    while True:
        found, pairs = _round(pairs, segs, percent, last=rounds >= FAMILY_ROUNDS)
        links = found if links is None else links.union(found)
        rounds += 1
        if pairs is None:
            return links


def _round(pairs: DataFrame, segs: DataFrame, percent: int, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """Links with the hubs and between members that do not both stay loose, and
    the loose members of large families with a hub from among them (None: no such
    family; all links are found)."""
    c, s = 100 - percent, 100 + percent
    total = F.col("na") + F.col("nb")
    star = _overlaps(pairs.select("a", "b"), segs).withColumn("linked", _links(F.col("both"), total, percent))
    star = materialize(star.withColumn("d", total - F.col("both") * 2), "hub-overlaps")

    # Differences from the hub: of members that share a bucket with a third
    # one, where the hub has some that do not link with it.
    members = star.join(pairs.where("crowd").select("a", "b"), ["a", "b"], "left_semi")
    loose = members.where(~F.col("linked")).select("b").distinct()
    members, seen = materialize_counted(members.join(loose, "b", "left_semi"), "loose-members")
    direct = star.where("linked").select("a", "b")
    if not seen["rows"]:
        return direct, None
    differ = F.array_union(F.array_except("ga", "gb"), F.array_except("gb", "ga"))
    diffs = _fragment_pairs(members.select("a", "b"), segs).select("a", "b", F.explode(differ).alias("gram"))
    diffs = materialize(diffs, "hub-differences")
    rare = diffs.groupBy("b", "gram").agg(F.count(F.lit(1)).alias("df"))
    # What only one member has joins nothing, but keeps its place in the order.
    w = Window.partitionBy("b", "a").orderBy("df", "gram")
    ranked = diffs.join(rare, ["b", "gram"]).withColumn("pos", F.row_number().over(w)).where("df > 1")
    ranked = materialize(ranked.join(members.drop("both"), ["a", "b"]), "ranked-differences")
    release(diffs)

    # For J(u, v) >= t: s |D(u) ^ D(v)| <= c (|u| + |v|), with s |D(u)| > c (|u| + |hub|) as u is loose.
    need_u = F.ceil((s * F.col("d") - c * total + (s - c)) / (2 * s))
    need_v = F.ceil((s * F.col("d") + c * (F.col("nb") - F.col("na")) + 1) / (2 * s))
    cols = ["b", "gram", "a", "na", "d", "pos"]
    u = ranked.where(~F.col("linked") & (F.col("pos") <= F.col("d") - need_u + 1)).select(*cols)
    v = ranked.where(F.col("pos") <= F.col("d") - need_v + 1).select(*cols, "linked")

    # Loose members that resemble each other more than the hub share most of their differences
    # from it. What one hub leaves of a large family gets the next hub, the family's own.
    families = None
    if not last:
        held = u.groupBy("b", "gram").agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("hub"))
        large = held.groupBy("b").agg(
            F.sum(F.col("n") * F.col("n")).alias("joined"), F.sum("n").alias("rows"), F.max(F.struct("n", "hub")).alias("top")
        )
        large = large.where(F.col("joined") > F.col("rows") * FAMILY_ROWS).select("b", F.col("top.hub").alias("hub"))
        families, seen = materialize_counted(large, "families")
        if not seen["rows"]:
            families = None
    if families is not None:
        v = v.join(families.select("b"), "b", "left_anti").union(
            v.join(families.select("b"), "b", "left_semi").where("linked")
        )
    v = v.drop("linked").toDF("b", "gram", "v", "nv", "dv", "posv")
    # Common elements needed, against what the rest of both orders can hold.
    need = s * (F.col("d") + F.col("dv")) - c * (F.col("na") + F.col("nv"))
    rest = F.least(F.col("d") - F.col("pos"), F.col("dv") - F.col("posv")) + 1
    more = u.join(v, ["b", "gram"]).where((F.col("a") != F.col("v")) & (2 * s * rest >= need))
    more = more.select(F.least("a", "v").alias("a"), F.greatest("a", "v").alias("b")).distinct()
    more = _overlaps(more, segs).where(_links(F.col("both"), total, percent))
    found = direct.union(more.select("a", "b"))
    if families is None:
        return found, None
    next_ = members.where(~F.col("linked")).select("a", "b").join(families, "b").where(F.col("a") != F.col("hub"))
    next_ = next_.select("a", F.col("hub").alias("b")).distinct().withColumn("crowd", F.lit(True))
    return materialize(found, "round-links"), materialize(next_, "family-pairs")


def keep_one(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest
    doc_id (of its texts, if it has several there, one). Documents without words
    or without an id stay, and of rows that are equal in all columns one stays.

    Rows are told apart by doc_id and text, so what happens to one text of a
    doc_id does not touch its others. Texts are moved only where rows repeat.
    """
    comp = _components(docs.select("doc_id", "text"), n, percent)
    leaves = (F.col("component_id") != F.col("doc_id")) | ~F.col("named")
    leaves = F.col("doc_id").isNotNull() & F.coalesce(leaves, F.lit(False))
    marks = comp.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(
        F.max(leaves).alias("_gone"), (F.count(F.lit(1)) > 1).alias("_again")
    )
    marks = _small(marks.where("_gone OR _again"), "marked-rows")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")
    rows = docs.select(row)
    same = F.col("d.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("d.text") == F.col("_th"))
    left = rows.join(marks, same, "left").where(~F.coalesce(F.col("_gone"), F.lit(False)))
    cols = [F.col("d").getField(c).alias(c) for c in docs.columns]
    once = left.where(F.col("_again").isNull() | ~F.col("_again")).select(*cols)
    if marks.where("_again AND NOT _gone").isEmpty():
        return once
    return once.union(left.where("_again").select(*cols).dropDuplicates())
