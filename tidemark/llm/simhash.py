"""SimHash near-duplicates: pigeonring keys, chain filter, components.

A fingerprint has a bit set where more than half of the text's shingle
hashes have it. Two fingerprints that differ in at most ``t`` bits are
looked for on a ring of 2t segments. The pigeonring principle: from some
start on the ring, every chain of l consecutive segments differs in at most
l * t / 2t = l / 2 bits, rounded down. So in the first six segments of that
chain at most none, one, one, two, two, three differ, and one of five sets of
three of these segments agrees exactly. Every (start, set) is a key: 40 a
fingerprint, each of 24 bits. Fingerprints that meet in a bucket are
candidates; those whose chains keep the budget from that start on go on to
the full Hamming check.

No bucket becomes all its pairs. Fingerprints are distinct; a bucket is cut
into chunks of about a hundred, compared inside a task, and only one link to
the least reachable member is given out for each member. Links are contracted
to components. Larger buckets that then still hold several components are
taken further by the same rule: the bits that the bucket has not fixed form a
ring of their own, with 40 keys again. Each step fixes three eighths of what
is left, so after a few steps no bucket can exceed a chunk. No link between
two components is left untested.

Defined results: a null or empty text, or one without words, has fingerprint
zero and is linked like any other; fewer words than a shingle are one
shingle; equal texts, repeated rows and repeated doc_ids share a component;
a null doc_id is carried as null and its component is the least doc_id that
is not null, if there is one; an empty table gives no rows. Texts of any
length are read whole. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .near_dedup import connected_components, mix

SHINGLE = 4
SEED = 42
DISTANCE = 4
BITS = 64
#: Segments of a chain that make up a key.
CHAIN = 6
#: Members of a bucket that one task compares with each other at most (chunks
#: of a larger bucket expect half as many).
CHUNK = 256


# ------------------------------------------------------------ fingerprints
def shingle_hashes(text: bytes, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, repeats included, in blocks."""
    words = b" ".join(text.lower().split())
    if not words:
        return
    gaps = np.flatnonzero(np.frombuffer(words, dtype=np.uint8) == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.append(gaps, len(words))
    last = max(1, len(starts) - size + 1)
    for at in range(0, last, 1 << 16):
        upto = min(at + (1 << 16), last)
        lo, hi = starts[at:upto].tolist(), ends[[-1]].tolist() if len(ends) < size else ends[at + size - 1:upto + size - 1].tolist()
        yield np.fromiter((xxhash.xxh64_intdigest(words[a:b], SEED) for a, b in zip(lo, hi)), dtype="<u8", count=upto - at)


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text, unsigned."""
    n, ones = 0, np.zeros(BITS, dtype=np.int64)
    for h in shingle_hashes(text or b"", size):
        n += len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp as the signed 64-bit number with the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), size) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")
                       ).mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- the ring
@lru_cache(maxsize=4096)
def ring_keys(fixed: int, distance: int = DISTANCE) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Keys over the bits that are not fixed: per (start, set) the mask of all
    bits that a bucket then shares, and the chain's (mask, budget) pairs."""
    m = 2 * distance
    free = [b for b in range(BITS) if not fixed >> b & 1]
    cuts = [len(free) * k // m for k in range(m + 1)]
    segment = [sum(1 << b for b in free[cuts[k]:cuts[k + 1]]) for k in range(m)]
    chain = min(CHAIN, m)
    out = []
    for start in range(m):
        turned = segment[start:] + segment[:start]
        budgets = tuple((sum(turned[:l]), l // 2) for l in range(1, m, 2))       # an even length adds nothing
        for off in combinations(range(chain), chain // 2):
            if all(sum(p < l for p in off) <= l // 2 for l in range(1, chain + 1)):
                out.append((fixed | sum(turned[p] for p in range(chain) if p not in off), budgets))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _first_entries(nodes: DataFrame, distance: int) -> DataFrame:
    """40 rows a fingerprint: bucket, ring (the bits fixed before), pattern, fp."""
    masks = F.array(*[F.struct(F.lit(k).alias("pattern"), F.lit(_signed(mask)).cast("long").alias("mask"))
                      for k, (mask, _) in enumerate(ring_keys(0, distance))])
    rows = nodes.select("fp", F.explode(masks).alias("k"))
    return rows.select(F.xxhash64("k.pattern", F.col("fp").bitwiseAND(F.col("k.mask"))).alias("bucket"),
                       F.lit(0).cast("long").alias("ring"), F.col("k.pattern").cast("int").alias("pattern"), "fp")


ENTRIES = "bucket long, ring long, pattern int, fp long"


def _finer_entries(rows: DataFrame, distance: int) -> DataFrame:
    """The members of large buckets on the ring of the bits that are not fixed yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, ring, pattern, fp = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            for r, p in sorted(set(zip(ring.tolist(), pattern.tolist()))):
                at = (ring == r) & (pattern == p)
                fixed = ring_keys(r & (1 << 64) - 1, distance)[p][0]
                b, x = bucket[at].view(np.uint64), fp[at].view(np.uint64)
                for k, (mask, _) in enumerate(ring_keys(fixed, distance)):
                    with np.errstate(over="ignore"):
                        key = mix(mix(b + np.uint64(k + 1)) ^ (x & np.uint64(mask)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(len(x), _signed(fixed), dtype=np.int64)),
                         pa.array(np.full(len(x), k, dtype=np.int32)), pa.array(x.view(np.int64))], names=["bucket", "ring", "pattern", "fp"])

    return rows.select("bucket", "ring", "pattern", "fp").mapInArrow(run, ENTRIES)


def linked(members: np.ndarray, budgets: tuple[tuple[int, int], ...], distance: int = DISTANCE) -> np.ndarray:
    """Buckets of equal size (k x s): per member the place of the least member
    of its bucket that it reaches by links inside the bucket."""
    k, s = members.shape
    differ = members[:, :, None] ^ members[:, None, :]
    near = np.ones((k, s, s), dtype=bool)
    for mask, most in budgets:                                  # the chain, segment after segment
        near &= np.bitwise_count(differ & np.uint64(mask)) <= most
    near[near] = np.bitwise_count(differ[near]) <= distance     # the full check of what is left
    label = np.broadcast_to(np.arange(s), (k, s))
    while True:
        least = np.where(near, label[:, None, :], s).min(axis=2)
        if (least == label).all():
            return label
        label = least


def _links(chunks: DataFrame, distance: int) -> DataFrame:
    """(a, b): from every member of a chunk to the least one that it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ring, pattern, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            begins = np.cumsum(sizes) - sizes
            alike = defaultdict(list)
            for i, key in enumerate(zip(ring, pattern, sizes.tolist())):
                alike[key].append(i)
            for (r, p, s), rows in alike.items():
                budgets = ring_keys(r & (1 << 64) - 1, distance)[p][1]
                step = max(1, (1 << 20) // (s * s))
                for at in range(0, len(rows), step):
                    members = flat[begins[rows[at:at + step]][:, None] + np.arange(s)]
                    label = linked(members, budgets, distance)
                    other = label != np.arange(s)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(members[other].view(np.int64)), pa.array(np.take_along_axis(members, label, 1)[other].view(np.int64))],
                        names=["a", "b"])

    return chunks.select("ring", "pattern", "members").mapInArrow(run, "a long, b long")


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(node, component) of the distinct fingerprints ``nodes`` (column fp) that
    have a link; a component is named by one of its fingerprints."""
    entries, component = _first_entries(nodes, distance), None
    while True:
        key = ["bucket", "ring", "pattern"]
        sizes = materialize(entries.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
                            .filter("n > 1"), "simhash-buckets")
        twos = sizes.filter("n = 2").select("ring", "pattern", F.array("lo", "hi").alias("members"))
        crowd = materialize(entries.join(sizes.filter("n > 2").select(*key, "n"), key), "simhash-crowds")
        salt = F.when(F.col("n") <= CHUNK, 0).otherwise(
            F.pmod(F.xxhash64("fp", "bucket"), F.ceil(F.col("n") * (2.0 / CHUNK)).cast("long")))
        chunks = crowd.withColumn("salt", salt).groupBy(*key, "salt").agg(F.collect_list("fp").alias("members"))
        found = _links(twos.unionByName(chunks.select("ring", "pattern", "members")), distance).distinct()
        if component is not None:
            found = found.unionByName(component.select(F.col("node").alias("a"), F.col("component").alias("b")))
        component = connected_components(found)
        large = crowd.filter(F.col("n") > CHUNK).select(*key, "fp")
        label = large.join(component.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
        several = label.groupBy("bucket").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).filter("_lo <> _hi")
        open_ = materialize(large.join(several.select("bucket"), "bucket"), "simhash-open")
        if not open_.limit(1).count():
            return component
        entries = materialize(_finer_entries(open_, distance), "simhash-entries")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, size: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, fp, and component_id, the least doc_id reachable
    over fingerprints at most ``distance`` bits apart."""
    marked = materialize(fingerprints(docs, size), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    component = links(nodes.select("fp"), distance)
    named = nodes.join(component.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
    # only components of several fingerprints are looked up again
    joined = (named.join(least.filter("n > 1").select("component", "component_id"), "component", "left")
              .select("fp", F.coalesce("component_id", "first").alias("component_id")))
    return marked.join(materialize(joined, "simhash-components"), "fp").select("doc_id", "fp", "component_id")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: fingerprint and component of every document."""
    from .common import table

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
