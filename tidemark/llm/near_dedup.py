"""Near-duplicate detection: DartMinHash signatures, bands, exact check.

An element is a shingle of five words, its weight one (or its count). Every
element owns the same plane for all documents: weight upwards, rank to the
right, cut into areas that expect one dart each; a hash of (element, area)
says how many darts fell there (Poisson) and where. A document's darts are
those under its weights with a rank below t / total weight, about t of them
whatever its length. Each dart belongs to one of k coordinates, and the
earliest per coordinate is the signature: two documents agree in a
coordinate with a probability equal to their (weighted) Jaccard similarity.
A document with an empty coordinate is thrown again with a larger t.

Signatures are cut into bands. Documents that share a band are candidates,
but a bucket never becomes all its pairs: its members are compared with a
pivot of the bucket, links found so far are contracted to components, and
only buckets that still hold several components go on. Of their members the
shingles that no other member of such a bucket has are counted: a member
with too many of them is done, and the member with the fewest is the next
pivot. What two members can have in common is bounded by what each shares
with that central member and by what is left of its shingles that anyone
else has; further pivots are drawn for what the bound leaves. No candidate link between two components is
left untested, and every candidate is checked on the whole texts.

Defined results: a null text counts as empty; equal texts are one class
whatever their size; a text of fewer than five words is one shingle; texts
that differ but have no words are classes of their own; repeated rows are
copies; a null doc_id is carried as null; texts of any length are read whole;
an empty table gives no rows. Other columns are ignored (and kept by
``deduplicate``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 6
#: Words whose hash a worker remembers before it starts afresh.
MEMO_WORDS = 100_000

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_POISSON = np.array([min(2 ** 64 - 1, int(sum(math.exp(-1) / math.factorial(j) for j in range(n + 1)) * 2 ** 64))
                     for n in range(20)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _WordHash()


def shingles(text: bytes | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a text, ascending, and their counts."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    if len(_WORDS) > MEMO_WORDS:
        _WORDS.clear()
    h = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(size, len(h))):
            out = mix(out + _GOLD) + h[k:k + n]
        return np.unique(mix(out), return_counts=True)


def dart_minhash(elements: list[np.ndarray], weights: list[np.ndarray], k: int) -> np.ndarray:
    """Signatures (documents x k) of sparse weighted sets; none may be empty."""
    out = np.full((len(elements), k), np.iinfo(np.uint64).max, dtype=np.uint64)
    todo, t = np.arange(len(elements)), k * math.log(k) + 2 * k
    while len(todo):
        got = _throw([elements[i] for i in todo], [weights[i] for i in todo], k, t)
        out[todo] = got
        todo = todo[(got == np.iinfo(np.uint64).max).any(axis=1)]
        t *= 2
    return out


def _throw(elements: list[np.ndarray], weights: list[np.ndarray], k: int, t: float) -> np.ndarray:
    size = np.array([len(e) for e in elements])
    total = np.array([w.sum() for w in weights], dtype=np.float64)
    doc = np.repeat(np.arange(len(elements)), size)
    e, w = np.concatenate(elements), np.concatenate(weights).astype(np.float64)
    limit = t / total                                   # darts of a higher rank are not needed
    sig = np.full(len(elements) * k, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for layer in range(int(math.ceil(math.log2(max(1.0, w.max())))) + 1):
            # weights [0, 1), [1, 2), [2, 4), ...; areas are 1 / height wide in rank
            floor = 0.0 if layer == 0 else 2.0 ** (layer - 1)
            height = 1.0 if layer == 0 else floor
            on = w > floor
            d_, e_, w_ = doc[on], e[on], w[on]
            areas = np.ceil(limit * height).astype(np.int64)[d_]
            at = np.repeat(np.arange(len(d_)), areas)
            area = np.arange(len(at)) - np.repeat(np.cumsum(areas) - areas, areas)
            seed = mix(e_[at] ^ mix((area.astype(np.uint64) << np.uint64(8)) + np.uint64(layer) + _GOLD))
            darts = np.searchsorted(_POISSON, mix(seed + _GOLD), side="right")
            back = np.repeat(np.arange(len(at)), darts)
            number = np.arange(len(back)) - np.repeat(np.cumsum(darts) - darts, darts)
            dart = mix(seed[back] + number.astype(np.uint64) * _M2 + _M1)
            place = mix(dart + _GOLD)
            rank = (area[back] + (place >> np.uint64(32)).astype(np.float64) * 2.0 ** -32) / height
            weight = floor + height * (place & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32
            own = at[back]
            d = d_[own]
            hit = (rank < limit[d]) & (weight < w_[own])
            dart, rank, d = dart[hit], rank[hit], d[hit]
            # earliest dart per coordinate: rank in the upper half, the dart's name in the lower
            slot = d * k + (dart >> np.uint64(33)).astype(np.int64) % k
            name = (np.minimum(rank * 2.0 ** 16, 2.0 ** 32 - 2).astype(np.uint64) << np.uint64(32)) | (
                dart & np.uint64(0xFFFFFFFF))
            np.minimum.at(sig, slot, name)
    return sig.reshape(len(elements), k)


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per document and band."""
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD), (len(signatures), bands)).copy()
        cut = signatures[:, :bands * rows].reshape(len(signatures), bands, rows)
        for r in range(rows):
            key = mix(key ^ mix(cut[:, :, r] + _GOLD)) + _M1
    return key


SIGNED = "node long, doc_id long, digest binary, n long, bands array<long>"


def signed(docs: DataFrame, weighted: bool = False, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """A row per document: digest of the text, number of shingles, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3)
            for at, n in _pieces(texts):
                part = batch.slice(at, n)
                sets = [shingles(t) for t in part.column(3).to_pylist()]
                full = [i for i, (e, _) in enumerate(sets) if len(e)]
                keys: list = [[]] * n
                if full:
                    sig = dart_minhash([sets[i][0] for i in full],
                                       [sets[i][1] if weighted else np.ones(len(sets[i][0])) for i in full], bands * rows)
                    for i, row in zip(full, band_keys(sig, bands, rows).view(np.int64)):
                        keys[i] = row
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array([len(e) for e, _ in sets], pa.int64()),
                     pa.array(keys, pa.list_(pa.int64()))], names=["node", "doc_id", "digest", "n", "bands"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows_ = docs.select(F.monotonically_increasing_id().alias("node"), F.col("doc_id").cast("long").alias("doc_id"),
                        _digest().alias("digest"), text.cast("binary").alias("text"))
    return rows_.mapInArrow(run, SIGNED)


def _digest():
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))


def _pieces(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(start, rows) of runs of about a megabyte of text, so memory stays bounded."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text.as_buffer()) if text.is_valid else 0
        if held >= most:
            yield start, i + 1 - start
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts) - start


def _are_stars(edges: DataFrame) -> bool:
    """Does every node point to one centre, and no centre anywhere?"""
    ends = (edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
            .unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))))
    known = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return not known.filter("out > 1 or (out > 0 and into > 0)").limit(1).count()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node of each connected component.

    Alternating large-star and small-star steps on an edge table until it
    holds only stars; every step is a grouped minimum joined back, written
    to shared files.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), "edges")
    while not _are_stars(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("a", "b", "m")
        e = materialize(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                        .unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "edges")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _shared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, na, nb, both): shingles of the whole texts and how many they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memo: dict[int, np.ndarray] = {}        # pivots repeat; a few dozen at most
            na, nb, both = [], [], []
            for b, ta, tb in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                x = shingles(ta.as_py())[0]
                if b not in memo:
                    if len(memo) > 32:
                        memo.clear()
                    memo[b] = shingles(tb.as_py())[0]
                y = memo[b]
                na.append(len(x))
                nb.append(len(y))
                both.append(len(np.intersect1d(x, y, assume_unique=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(v, pa.int64()) for v in (na, nb, both))],
                                             names=["a", "b", "na", "nb", "both"])

    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(
        run, "a long, b long, na long, nb long, both long")


def _similar(both: Column, n: Column, n2: Column, threshold: float) -> Column:
    return both >= threshold * (n + n2 - both) - 1e-9


def _may_reach(threshold: float) -> Column:
    """Can two members of a bucket reach the threshold? They share at most
    what each shares with the bucket's central member, and of the rest at
    most what each shares with anyone."""
    most = F.least("inside", "inside2") + F.least("outside", "outside2")
    return _similar(most, F.col("n"), F.col("n2"), threshold)


def _merged(component: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links; nodes without a link have no row."""
    if component is None:
        return connected_components(links)
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    known = materialize(ends.join(component, "node", "full").select(
        "node", F.coalesce("component", "node").alias("component")), "components")
    of = lambda end: known.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = connected_components(between).select(F.col("node").alias("component"), F.col("component").alias("_to"))
    return materialize(known.join(joined, "component", "left").select(
        "node", F.coalesce("_to", "component").alias("component")), "components")


def _open(shared: DataFrame, component: DataFrame | None) -> DataFrame:
    """Rows of the buckets that hold several components, with the component."""
    label = shared.drop("component")
    label = (label.withColumn("component", F.col("node")) if component is None else
             label.join(component, "node", "left").withColumn("component", F.coalesce("component", "node")))
    several = (label.groupBy("bucket").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"),
                                           F.count(F.lit(1)).alias("members")).filter("_lo <> _hi").select("bucket", "members"))
    return materialize(label.drop("members").join(several, "bucket"), "open")


def _common(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, c): how many of its shingles a node shares with any other of the nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = shingles(text.as_py())[0].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(np.full(len(x), node))], names=["shingle", "node"])

    rows = texts.join(nodes.select("node").distinct(), "node", "left_semi").select("node", "text").mapInArrow(
        run, "shingle long, node long")
    lone = rows.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("_m")).filter("node = _m")
    return lone.groupBy("node").agg(F.count(F.lit(1)).alias("lone"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, weighted: bool = False,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: node, doc_id, digest, text_class (node of the first equal
    text), and component (of text classes linked at the threshold or more)."""
    sig = materialize(signed(docs, weighted, bands, rows), "signatures")
    classes = materialize(sig.groupBy("digest").agg(F.min("node").alias("text_class"), F.count(F.lit(1)).alias("copies")), "text-classes")
    firsts = sig.join(classes.select(F.col("text_class").alias("node")), "node", "left_semi")
    entries = firsts.select("node", "n", F.explode("bands").alias("bucket"))
    sizes = (entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"),
                                           F.min(F.struct(F.xxhash64("node").alias("h"), "node", "n")).alias("p"))
             .filter("members > 1").select("bucket", "members", F.col("p.node").alias("pivot"), F.col("p.n").alias("n2")))
    shared = materialize(entries.join(sizes, "bucket"), "buckets")

    named = sig.join(shared.select("node").distinct(), "node").select("node", "digest", F.col("doc_id").alias("_doc"))
    source = docs.select(F.col("doc_id").cast("long").alias("_doc"), _digest().alias("digest"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    match = (source["digest"] == named["digest"]) & source["_doc"].eqNullSafe(named["_doc"])
    texts = materialize(source.join(named, match).select("node", "text").dropDuplicates(["node"]), "texts")

    def once(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).filter("a <> b").distinct()

    def test(pairs: DataFrame) -> DataFrame:
        """Count what the pairs share; merge the components of those that are similar."""
        nonlocal component
        counted = materialize(_shared(materialize(pairs, "pairs"), texts), "counted")
        links = counted.filter(_similar(F.col("both"), F.col("na"), F.col("nb"), threshold)).select("a", "b")
        if component is None or links.limit(1).count():
            component = _merged(component, links)
        return counted

    component = None
    size_ok = F.least("n", "n2") >= threshold * F.greatest("n", "n2") - 1e-9
    tested = [test(once(shared.filter(size_ok).withColumn("other", F.col("pivot")))).select("a", "b")]

    # a bucket of two is done; of the others, members with too few shared shingles are
    open_ = _open(shared.filter("members > 2").drop("pivot", "n2"), component)
    lone = _common(texts, open_)
    open_ = (open_.join(lone, "node", "left").withColumn("c", F.col("n") - F.coalesce("lone", F.lit(0)))
             .drop("lone").filter(F.col("c") >= threshold * F.col("n") - 1e-9))
    open_ = _open(open_, component)
    best = open_.groupBy("bucket").agg(F.min(F.struct((1 - F.col("c") / F.col("n")).alias("u"), F.xxhash64("node").alias("h"), "node")
                                             ).alias("p")).select("bucket", F.col("p.node").alias("other"))
    open_ = materialize(open_.join(best, "bucket"), "open")
    counted = test(once(open_))
    tested.append(counted.select("a", "b"))
    with_best = counted.select("a", "b", "both").unionByName(counted.select(F.col("b").alias("a"), F.col("a").alias("b"), "both"))
    open_ = (open_.join(with_best.select(F.col("a").alias("node"), F.col("b").alias("other"), "both"), ["node", "other"], "left")
             .withColumn("inside", F.coalesce("both", "n")).withColumn("outside", F.greatest(F.col("c") - F.col("inside"), F.lit(0)))
             .drop("other", "both"))

    pivots = 32
    while True:
        open_ = _open(open_, component)
        most = open_.agg(F.max("members")).first()[0]
        if most is None:
            break
        draw = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 40)) / float(1 << 40)
        chosen = (open_.withColumn("draw2", draw).filter(F.col("draw2") * F.col("members") < pivots)
                  .select("bucket", F.col("node").alias("other"), F.col("n").alias("n2"), F.col("inside").alias("inside2"),
                          F.col("outside").alias("outside2"), F.col("component").alias("component2"), "draw2"))
        met = open_.withColumn("draw", draw).join(chosen, "bucket").filter(
            _may_reach(threshold) & (F.col("component") != F.col("component2")) & (F.col("draw2") < F.col("draw")))
        fresh = once(met).join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti")
        tested.append(test(fresh).select("a", "b"))
        if most <= pivots:                  # every member has been a pivot
            break
        pivots *= 32
    named = classes.join(component.withColumnRenamed("node", "text_class"), "text_class", "left").select(
        "digest", "copies", "text_class", F.coalesce("component", "text_class").alias("component"))
    return (join_hot(sig.select("node", "doc_id", "digest"), materialize(named, "named-classes"), "digest", "copies", sig.count())
            .select("node", "doc_id", "digest", "text_class", "component"))


def representatives(found: DataFrame) -> DataFrame:
    """Per component its first document: least doc_id (nulls last), then node."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    best = found.groupBy("component").agg(F.min(order).alias("_r"), F.min_by("digest", order).alias("class_digest"),
                                          F.count(F.lit(1)).alias("class_size"))
    return best.select("component", F.col("_r.doc_id").alias("class_id"), F.col("_r.node").alias("class_node"),
                       "class_digest", "class_size")


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents (all their columns), one of each class of near copies."""
    kept = representatives(near_duplicates(docs, threshold)).select("class_digest", "class_id")
    marked = docs.select(F.struct("*").alias("row"), _digest().alias("digest"), F.col("doc_id").cast("long").alias("id"))
    same = (marked["digest"] == kept["class_digest"]) & marked["id"].eqNullSafe(kept["class_id"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["digest", "id"]).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the class of near copies of every document."""
    from .common import table

    found = materialize(near_duplicates(table(spark, sf_dir, "documents")), "near")
    classes = materialize(representatives(found), "classes")
    return (join_hot(found, classes, "component", "class_size", found.count())
            .select("doc_id", "class_id", "class_size", (F.col("node") == F.col("class_node")).alias("kept")))
