"""N-gram Jaccard join: rare shingles deal documents to R-trees of their group counts."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import durable
from .graph import components
from .registry import extra, partitions, query, table
from .words import shingles, texts_of, windows, word_hashes

GROUPS = 512
#: 100 * intersection >= 80 * union, as 9 * intersection >= 4 * (sum of both sizes).
OVERLAP, SIZES = 9, 4
_CHUNK = 1 << 21
#: Buckets of more classes are indexed by R-trees; smaller ones are a leaf each.
LEAF = 64
#: Rounds of comparing each class with one head; a large group of near copies may need them all.
MOST_ROUNDS = 12


def frequent_shingles(texts: DataFrame, least: int = 100, most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that stand out in ``texts(text)`` and their counts, sorted by shingle.

    Each task counts all its shingles, some millions at a time, and reports those that come
    6 times or more; the sums decide. There are at most ``most`` of them, as no more can
    pass the threshold that their total sets. They only steer the order of shingles, so
    one that is missed or miscounted costs time but no link.
    """

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for text in texts_of(batch.column(0)):
                if text:
                    held.append(windows(word_hashes(text, lower=True), 5))
                    size += len(held[-1])
                if size >= _CHUNK:
                    yield report(held)
                    held, size = [], 0
        if held:
            yield report(held)

    def report(held):
        tokens = np.concatenate(held)
        cells = (tokens >> np.uint64(64 - 21)).astype(np.int64)
        tokens = tokens[np.bincount(cells, minlength=1 << 21)[cells] >= 6]
        tokens, n = np.unique(tokens, return_counts=True)
        often = n >= 6
        return pa.RecordBatch.from_arrays(
            [pa.array(tokens[often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["token", "n"]
        )

    counted = durable(texts.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    found = counted.where(F.col("n") >= max(least, -(-total // most))).toArrow()
    tokens = np.asarray(found["token"], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.asarray(found["n"], np.int64)[order]


def _sketches(spark: SparkSession, frequent: tuple[np.ndarray, np.ndarray]):
    """A function of texts: size, 128-bit digest, group counts and rarest shingles of their sets."""
    shared = spark.sparkContext.broadcast(frequent)
    schema = "struct<n:bigint,s1:bigint,s2:bigint,point:binary,prefix:array<bigint>>"

    def sketch(texts: pa.Array) -> pa.Array:
        tokens, counts = shared.value
        stands_out = np.zeros(1 << 20, bool)
        stands_out[tokens >> np.uint64(44)] = True
        n, digests, points, prefixes = [], [], [], []
        for text in texts_of(texts):
            found = shingles(text or b"")
            n.append(len(found))
            digests.append(np.frombuffer(blake2b(found.tobytes(), digest_size=16).digest(), np.int64))
            points.append(packed(np.bincount(found & np.uint64(GROUPS - 1), minlength=GROUPS)))
            maybe = np.flatnonzero(stands_out[found >> np.uint64(44)])
            if len(maybe):
                at = np.searchsorted(tokens, found[maybe]).clip(max=len(tokens) - 1)
                often = np.zeros(len(found), np.int64)
                often[maybe] = np.where(tokens[at] == found[maybe], counts[at], 0)
                found = found[np.argsort(often, kind="stable")]
            # Two sets that link share one of their first shingles, in any order common to all.
            prefixes.append(found[: len(found) - -(-4 * len(found) // 5) + 1])
        digests = np.array(digests, np.int64).reshape(-1, 2)
        offsets = np.r_[0, np.cumsum([len(p) for p in prefixes], dtype=np.int32)]
        values = np.concatenate([*prefixes, np.zeros(0, np.uint64)]).view(np.int64)
        return pa.StructArray.from_arrays(
            [
                pa.array(n, pa.int64()),
                pa.array(digests[:, 0]),
                pa.array(digests[:, 1]),
                pa.array(points, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
            ],
            ["n", "s1", "s2", "point", "prefix"],
        )

    return F.arrow_udf(sketch, schema).asNondeterministic()


def packed(counts: np.ndarray) -> bytes:
    """Group counts in a byte each, or in four where one is over 255."""
    return counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes()


def unpacked(points: list[bytes]) -> np.ndarray:
    """A row for each point; as small a type as all of them allow."""
    if all(len(p) == GROUPS for p in points):
        return np.frombuffer(b"".join(points), np.uint8).reshape(-1, GROUPS)
    return np.stack([np.frombuffer(p, np.uint8 if len(p) == GROUPS else np.uint32).astype(np.uint32) for p in points])


class RTree:
    """Group counts packed into leaves by size; a leaf's corner bounds the overlap with all it holds."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, leaf: int = 16) -> None:
        # Sorted by size, then by the heaviest coordinates: neighbours share a leaf.
        order = np.lexsort((*points[:, :2].T, sizes))
        self.leaves = [order[i : i + leaf] for i in range(0, len(order), leaf)]
        self.corners = np.stack([points[x].max(0) for x in self.leaves])
        self.least = np.array([sizes[x].min() for x in self.leaves])
        self.points, self.sizes = points, sizes

    def near(self, point: np.ndarray, size: int) -> np.ndarray:
        """Entries whose summed coordinate minima allow a link."""
        alike = OVERLAP * np.minimum(self.corners, point).sum(1, dtype=np.int64) >= SIZES * (size + self.least)
        rows = [self.leaves[i] for i in np.flatnonzero(alike)]
        if not rows:
            return np.zeros(0, np.int64)
        at = np.concatenate(rows)
        bound = np.minimum(self.points[at], point).sum(1, dtype=np.int64)
        return at[OVERLAP * bound >= SIZES * (size + self.sizes[at])]


class Buckets:
    """The buckets of each class, to list a pair only in the first bucket that both are in."""

    def __init__(self) -> None:
        self.of: dict[int, frozenset[int]] = {}

    def add(self, rep: int, buckets: np.ndarray) -> frozenset[int]:
        if rep not in self.of:
            if len(self.of) >= 20_000:
                self.of.clear()
            self.of[rep] = frozenset(buckets.tolist())
        return self.of[rep]


def _tile_pairs(bucket: int, lo: int, hi: int, ids, sizes, roots, chunks, points, lists, known: Buckets):
    """Pairs of one tile that the bound lets pass, of different components, not listed in an earlier bucket."""
    out = []
    if lo == hi:
        probe = index = np.arange(len(ids))
    else:
        probe, index = np.flatnonzero(chunks == lo), np.flatnonzero(chunks == hi)
    if not len(probe) or not len(index) or (roots == roots[0]).all():
        return out
    tree = RTree(points[index], sizes[index])
    for i in probe:
        found = index[tree.near(points[i], sizes[i])]
        found = found[(roots[found] != roots[i]) & ((ids[found] > ids[i]) if lo == hi else True)]
        if len(found):
            mine = known.add(int(ids[i]), lists(i))
            first = [j for j in found if min(mine & known.add(int(ids[j]), lists(j))) == bucket]
            out += [(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in first]
    return out


def _bucket_pairs(batches):
    """Split the sorted rows into their (bucket, lo, hi) tiles and probe each tile's R-tree."""
    rest, known = None, Buckets()

    def pairs(tab):
        tab = tab.combine_chunks()
        key = np.stack([np.asarray(tab[c], np.int64) for c in ("bucket", "lo", "hi")], 1)
        ids, roots, chunks = (np.asarray(tab[c], np.int64) for c in ("rep", "root", "chunk"))
        points = unpacked(tab["point"].to_pylist())
        sizes = points.sum(1, dtype=np.int64)
        lists = tab["buckets"].chunk(0)
        starts, values = np.asarray(lists.offsets), np.asarray(lists.values, np.int64)
        edges = np.r_[0, np.flatnonzero((np.diff(key, axis=0) != 0).any(1)) + 1, len(key)]
        found = []
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            own = lambda i, s=s: values[starts[s + i] : starts[s + i + 1]]
            found += _tile_pairs(*key[s].tolist(), ids[s:e], sizes[s:e], roots[s:e], chunks[s:e], points[s:e], own, known)
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        tab = pa.Table.from_batches([batch])
        if rest is not None and rest.num_rows:
            tab = pa.concat_tables([rest, tab])
        if not tab.num_rows:
            continue
        last = [tab[c][-1].as_py() for c in ("bucket", "lo", "hi")]
        cut = tab.num_rows
        while cut and [tab[c][cut - 1].as_py() for c in ("bucket", "lo", "hi")] == last:
            cut -= 1
        if cut:
            yield pairs(tab.slice(0, cut))
        rest = tab.slice(cut)
    if rest is not None and rest.num_rows:
        yield pairs(rest)


def _may_link(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether the summed coordinate minima of two points allow a link; a point sums to its set's size."""
    out = []
    for at in range(0, len(a), 1024):
        x, y = (unpacked(c.slice(at, 1024).to_pylist()) for c in (a, b))
        both, sizes = (np.minimum(x, y).sum(1, dtype=np.int64), x.sum(1, dtype=np.int64) + y.sum(1, dtype=np.int64))
        out.append(OVERLAP * both >= SIZES * sizes)
    return pa.array(np.concatenate(out) if out else np.zeros(0, bool), pa.bool_())


def bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The ``pairs(a, b)`` whose points allow a link."""
    a, b = (points.select(F.col("rep").alias(c), F.col("point").alias(f"point_{c}")) for c in "ab")
    may = F.arrow_udf(_may_link, "boolean")
    return pairs.join(a, "a").join(b, "b").where(may("point_a", "point_b")).select("a", "b")


def _linked(batches):
    """Pairs that link, from rows sorted by hub and salt: the hub's text first, then its partners'."""
    hub, seen = None, None
    for batch in batches:
        found = []
        hubs, salts, partners = (batch.column(i).to_pylist() for i in range(3))
        for at, text in enumerate(texts_of(batch.column(3))):
            if partners[at] is None:
                hub, seen = (hubs[at], salts[at]), shingles(text)
                continue
            assert hub == (hubs[at], salts[at])
            mine = shingles(text)
            both = len(np.intersect1d(mine, seen, assume_unique=True))
            if OVERLAP * both >= SIZES * (len(mine) + len(seen)):
                found.append((partners[at], hub[0]))
        a, b = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, small: int = 500_000, salted: int = 256) -> DataFrame:
    """The ``pairs(a, b)`` whose texts link. Texts are read only for classes in a pair.

    Of a pair, the class with more partners is the hub. A hub's text goes once to each
    task that has some ``salted`` of its partners' texts, and tasks read texts one by one.
    The list of the classes is broadcast if it has at most ``small`` rows (24 bytes
    each); a longer one is joined by a shuffle.
    """
    ends = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))
    degrees = durable(ends.groupBy("rep").agg(F.count(F.lit(1)).alias("degree")))
    needed = durable(classes.select("rep", "doc_id", "text_key").join(degrees.select("rep"), "rep"))
    if needed.count() <= small:
        needed = F.broadcast(needed)
    same = F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("r.text_key") == F.col("k.text_key"))
    texts = durable(rows.alias("r").join(needed.alias("k"), same).select("rep", "text").dropDuplicates(["rep"]))
    degree = lambda c: degrees.select(F.col("rep").alias(c), F.col("degree").alias(f"d{c}"))
    swap = F.col("da") > F.col("db")
    turned = pairs.join(degree("a").hint("merge"), "a").join(degree("b").hint("merge"), "b").select(
        F.when(swap, F.col("a")).otherwise(F.col("b")).alias("hub"),
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("partner"),
        F.ceil(F.greatest("da", "db") / salted).alias("parts"),
    )
    turned = durable(turned.select("hub", F.pmod(F.xxhash64("partner"), F.col("parts")).alias("salt"), "partner"))
    heads = turned.select("hub", "salt").distinct().join(texts, F.col("hub") == F.col("rep"))
    heads = heads.select("hub", "salt", F.lit(None).cast("long").alias("partner"), "text")
    probes = turned.join(texts, F.col("partner") == F.col("rep")).select("hub", "salt", "partner", "text")
    dealt = heads.unionByName(probes).repartition(partitions(rows), "hub", "salt")
    return durable(dealt.sortWithinPartitions("hub", "salt", "partner").mapInArrow(_linked, "a long, b long"))


def _leaf_pairs(members: DataFrame, points: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Pairs across components in buckets of up to ``leaf`` classes, each looked at once, that the bound lets pass."""
    small = members.where(F.col("members") <= leaf)
    a, b = (
        small.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("rep", "root", "n", "place")]).hint("merge") for side in "ab"
    )
    # The first token that two sets share has all the others behind it, in either set.
    left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    fits = (OVERLAP * left >= SIZES * (F.col("n_a") + F.col("n_b"))) & (F.col("rep_a") < F.col("rep_b"))
    pairs = a.join(b, (a.token == b.token) & fits & (F.col("root_a") != F.col("root_b")))
    return bounded(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct(), points)


def _tree_pairs(members: DataFrame, points: DataFrame, leaf: int = LEAF, side: int = 512) -> DataFrame:
    """Pairs across components in larger buckets: tiles of about ``side`` by ``side`` classes, an R-tree in each.

    A class knows its larger buckets, at most as many as its first shingles, so a pair is
    listed once and not again for each bucket that both are in.
    """
    large = members.where(F.col("members") > leaf).drop("n", "place")
    numbers = durable(large.select("token").distinct().withColumn("bucket", F.monotonically_increasing_id()))
    large = durable(large.join(numbers, "token").drop("token"))
    own = large.groupBy("rep").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))
    tiles = F.ceil(F.col("members") / side).cast("int")
    dealt = (
        large.join(durable(own.join(points, "rep")), "rep")
        .withColumn("chunk", F.pmod(F.xxhash64("rep"), tiles))
        .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .select(
            "bucket",
            F.least("chunk", "other").cast("long").alias("lo"),
            F.greatest("chunk", "other").cast("long").alias("hi"),
            "rep",
            "root",
            F.col("chunk").cast("long").alias("chunk"),
            "point",
            "buckets",
        )
    )
    sorted_tiles = dealt.repartition(partitions(members), "bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    return sorted_tiles.mapInArrow(_bucket_pairs, "a long, b long")


def _mixed(members: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components; dealt by token once."""
    dealt = members.repartition(partitions(members), "token")
    ends = dealt.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1")
    return dealt.join(ends.select("token").hint("merge"), "token")


def _stars(members: DataFrame, number: int) -> DataFrame:
    """(a, b): for each class the head, of another component, with which it shares most buckets.

    The head of a bucket is the class with the smallest hash, another one in each round.
    """
    dealt = members.withColumn("h", F.xxhash64("rep", F.lit(number))).repartition(partitions(members), "token")
    lowest = dealt.groupBy("token").agg(F.min("h").alias("lowest"))
    heads = dealt.join(lowest.hint("merge"), "token").where("h = lowest")
    heads = heads.select("token", F.col("rep").alias("b"), F.col("root").alias("root_b"), F.col("n").alias("n_b"))
    alike = "root <> root_b AND 5 * n >= 4 * n_b AND 5 * n_b >= 4 * n"
    votes = dealt.join(heads.hint("merge"), "token").where(alike).groupBy("rep", "b").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("rep").agg(F.max(F.struct("votes", "b")).alias("best"))
    return best.select(F.col("rep").alias("a"), F.col("best.b").alias("b"))


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows of ``docs``, their sets, the classes of equal sets, and each bucket's classes where there are several."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    sketch = _sketches(docs.sparkSession, frequent_shingles(rows))
    sets = durable(rows.select("doc_id", "text_key", sketch("text").alias("s")).select("doc_id", "text_key", "s.*"))
    firsts = sets.where("n > 0").groupBy("s1", "s2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "n", "point", "prefix")).alias("f")
    )
    classes = durable(
        firsts.select(F.monotonically_increasing_id().alias("rep"), "s1", "s2", "f.doc_id", "f.text_key", "f.n", "f.point", "f.prefix")
    )
    dealt = classes.select("rep", "n", F.posexplode("prefix").alias("place", "token")).repartition(partitions(docs), "token")
    buckets = dealt.groupBy("token").agg(F.min("rep").alias("r0"), F.max("rep").alias("r1"), F.count(F.lit(1)).alias("members"))
    several = buckets.where("r0 < r1").select("token", "members").hint("merge")
    shared = durable(dealt.join(several, "token").select("token", "rep", "members", "n", "place"))
    return rows, sets, classes, shared


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links of a Jaccard of 0.8 or more: pairs of classes, and the class of every row.

    The first table has (a, b) with a < b for every two classes of equal sets that link,
    each pair once and verified on whole sets, those inside a component as well. So its
    rows grow with the square of a group of different near duplicates. The second has
    doc_id, text_key, n_shingles and rep (the class; null for texts without words) of every row.
    """
    rows, sets, classes, shared = _dealt(docs, id_col, text_col)
    points = classes.select("rep", "point")
    # Each class is its own root: no pair is left out.
    apart = durable(shared.withColumn("root", F.col("rep")))
    pairs = _leaf_pairs(apart, points).unionByName(_tree_pairs(apart, points))
    found = verified(durable(pairs.distinct()), classes.select("rep", "doc_id", "text_key"), rows)
    links = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    of = classes.select("rep", F.col("s1").alias("c1"), F.col("s2").alias("c2"))
    filled = sets.where("n > 0").join(of, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")))
    members = filled.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "rep").unionByName(
        sets.where("n = 0").select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("rep"))
    )
    return links, members


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3) -> DataFrame:
    """The connected component of every row of ``docs`` under a Jaccard link of 0.8 or more.

    A text's set holds its distinct shingles of five lower-cased words. Equal sets form a
    class at once. Two classes that link share one of their rarest shingles, a fifth of
    each set and one more, in an order where frequent shingles come last: these deal the
    classes into buckets. In ``rounds`` rounds each class is compared with one head of its
    buckets; classes that so come under one root need no more comparing with each other. Then
    every bucket that still holds several components indexes its classes' group counts:
    a small bucket is one leaf, a larger one has R-trees over tiles of bounded size. All
    pairs across components whose summed coordinate minima allow a link are verified on
    their whole sets. No link between components is lost; ``near_pairs`` lists those within one.

    Returns doc_id, text_key (hash of the text), n_shingles, component_id (smallest id reached) and first
    (whether the row's id and text are the component's first). Null, empty and blank texts have
    no set and are linked with nothing: their own component and first. Rows equal in id
    and text are one; a null id is the smallest reached only where there is no other. An
    empty table gives no rows. Other columns are ignored.
    """
    rounds = max(1, rounds)
    rows, sets, classes, shared = _dealt(docs, id_col, text_col)
    filled = sets.where("n > 0")
    thin = classes.select("rep", "doc_id", "text_key")
    points = classes.select("rep", "point")
    roots, first = None, 0
    open_rows = shared.withColumn("root", F.col("rep"))
    for number in range(MOST_ROUNDS):
        found = verified(durable(bounded(_stars(open_rows, number), points)), thin, rows)
        n = found.count()
        first = first or n
        if number >= rounds and 10 * n < first:
            break
        # Linked classes hang on their root, so each round starts from stars and settles in a few steps.
        links = found if roots is None else found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = durable(components(links))
        rooted = shared.join(roots, F.col("rep") == F.col("node"), "left").select(
            "token", "rep", F.coalesce("root", "rep").alias("root"), "members", "n", "place"
        )
        open_rows = durable(_mixed(rooted))
    pairs = _leaf_pairs(open_rows, points).unionByName(_tree_pairs(open_rows, points))
    more = verified(durable(pairs.distinct()), thin, rows)
    hung = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = durable(components(hung.unionByName(found).unionByName(more)))
    rooted_classes = (
        classes.select("rep", "s1", "s2", "doc_id", "text_key")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select("s1", "s2", "doc_id", "text_key", F.coalesce("root", "rep").alias("root"))
    )
    rooted_classes = durable(rooted_classes)
    lead = rooted_classes.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("lead")
    )
    # As small as the classes that are not alone; those alone lead themselves.
    labelled = rooted_classes.join(lead, "root").select(
        F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.col("lead.doc_id").alias("lead_id"), F.col("lead.text_key").alias("lead_key")
    )
    joined = filled.drop("point", "prefix").join(
        labelled, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2"))
    )
    placed = joined.select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.col("lead_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("lead_id")) & (F.col("text_key") == F.col("lead_key"))).alias("first"),
    )
    alone = sets.where("n = 0").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("first")
    )
    return placed.unionByName(alone)


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query(rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM w),
k AS MATERIALIZED (SELECT md5(array_to_string(s, chr(10))) AS k, min(doc_id) AS id, any_value(s) AS s, any_value(len(s)) AS n FROM s WHERE len(s) > 0 GROUP BY 1),
p AS MATERIALIZED (SELECT id, n, unnest(s) AS t FROM k),
i AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.t = b.t AND a.id < b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS MATERIALIZED (SELECT a, b FROM i UNION SELECT b, a FROM i),
r AS (SELECT id AS a, id AS b FROM k UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS id, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN k ON len(s.s) > 0 AND md5(array_to_string(s.s, chr(10))) = k.k LEFT JOIN c ON c.id = k.id
""")
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@extra
def near_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, number of linked classes and class of every document; no link is left out."""
    pairs, members = near_pairs(table(spark, sf_dir, "documents"))
    ends = pairs.select(F.col("a").alias("end")).unionByName(pairs.select(F.col("b").alias("end")))
    counts = ends.groupBy("end").agg(F.count(F.lit(1)).alias("n_links"))
    linked = members.join(counts, F.col("rep") == F.col("end"), "left")
    return linked.select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("rep").alias("class_id"))
