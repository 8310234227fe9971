"""Benchmark decontamination with suffix arrays of the training text.

Training documents are taken in shards of about ``SHARD_WORDS`` words (whole
documents). Each shard is turned into word ids, its suffixes are sorted, and
every suffix of the test items is binary-searched in that suffix array, all
at once, one word of depth at a time. The intervals found at the window
length are the places where a window occurs verbatim; runs of places on one
diagonal give the longest match.

Words that no test item has can begin no match, and a run of known words
that is shorter than the shortest window can hold none, so such suffixes are
left out of the array; nothing else is.

A window is ``window`` consecutive words of an item; an item of fewer words
(but not none) is one window.

Defined results: null or empty texts have no words and no hits; repeated
documents are reported each for itself; repeated item_ids count once; a null
item_id is the empty string; an empty benchmark hits nothing; texts of any
length are searched whole; an empty table of documents gives no rows; columns
other than the id and the text are kept or ignored. A benchmark
of more than ``BLOCK_WORDS`` words is dealt by hash into blocks of about that
size (an item is never cut), and one block after the other is on the driver
and broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize

WINDOW = 10
SHARD_WORDS = 1 << 19
BLOCK_WORDS = 1 << 20

# A-Z to a-z; every byte that is not 0-9, a-z or part of a non-ASCII
# character to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class ItemBlock:
    """Suffixes of a block of test items, as word ids from 1 (0: no such word)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        ids: list[int] = []
        starts, lengths, owner = [], [], []
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        for name, words in items:
            size = min(window, len(words))
            at = len(ids)
            ids += [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
            for p in range(len(words) - size + 1 if size else 0):
                starts.append(at + p)
                lengths.append(size)
                owner.append(number[name])
            ids.append(0)
        self.ids = np.array(ids or [0], dtype=np.int64)
        self.start = np.array(starts, dtype=np.int64)
        self.length = np.array(lengths, dtype=np.int64)
        self.owner = np.array(owner, dtype=np.int64)
        self.shortest = int(self.length.min()) if starts else 0
        self.longest = int(self.length.max()) if starts else 0


def suffix_array(ids: np.ndarray, at: np.ndarray, n_ids: int, depth: int) -> np.ndarray:
    """The positions ``at`` of ``ids``, sorted by the ``depth`` ids from each on.

    As many ids as fit 62 bits make the first sort key; ranks of those keys
    are then combined, so a depth of some tens takes two or three sorts.
    """
    padded = np.concatenate([ids, np.zeros(depth + 64, dtype=np.int64)])
    covered, rank, size = 1, padded, n_ids + 1
    while True:
        bits = max(1, int(size - 1).bit_length())
        count = max(2, min(62 // bits, -(-depth // covered)))
        need = len(rank) - covered * (count - 1)
        key = rank[:need].copy()
        for k in range(1, count):
            key = (key << bits) | rank[k * covered:k * covered + need]
        covered *= count
        if covered >= depth:
            return at[np.argsort(key[at], kind="stable")]
        _, rank = np.unique(key, return_inverse=True)
        rank = np.concatenate([rank, np.zeros(covered, dtype=np.int64)])
        size = int(rank.max()) + 1


def _bound(ids: np.ndarray, array: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int,
           word: np.ndarray, after: bool) -> np.ndarray:
    """Binary search in every interval [lo, hi) of the array at once."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        seen = ids[array[np.minimum(mid, len(array) - 1)] + depth]
        right = open_ & ((seen <= word) if after else (seen < word))
        lo = np.where(right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)
    return lo


def find_windows(ids: np.ndarray, array: np.ndarray, block: ItemBlock) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of every occurrence of a test window in the shard."""
    active = np.arange(len(block.start))
    lo, hi = np.zeros(len(active), dtype=np.int64), np.full(len(active), len(array), dtype=np.int64)
    found_q, found_lo, found_hi = [], [], []
    for depth in range(block.longest):
        word = block.ids[block.start[active] + depth]
        lo, hi = (_bound(ids, array, lo, hi, depth, word, False), _bound(ids, array, lo, hi, depth, word, True))
        full = (lo < hi) & (block.length[active] == depth + 1)
        found_q.append(active[full])
        found_lo.append(lo[full])
        found_hi.append(hi[full])
        go = (lo < hi) & ~full
        active, lo, hi = active[go], lo[go], hi[go]
        if not len(active):
            break
    q, a, b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (found_q, found_lo, found_hi))
    n = b - a
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(q, n), array[np.repeat(a, n) + inside]


def match_shard(docs: list[list[bytes]], block: ItemBlock) -> dict[int, tuple[list[tuple[int, int]], list[str], int]]:
    """{document number: (hit spans in words, item names, longest match)} of one shard."""
    if not block.shortest:
        return {}
    size = np.array([len(w) + 1 for w in docs], dtype=np.int64)
    begin = np.cumsum(size) - size
    ids = np.zeros(int(size.sum()) + 1, dtype=np.int64)
    for at, words in zip(begin, docs):
        ids[at:at + len(words)] = np.fromiter(map(block.vocab.get, words, repeat(0)), dtype=np.int64, count=len(words))
    # length of the run of known words that begins at each position
    unknown = np.flatnonzero(ids == 0)
    run = unknown[np.searchsorted(unknown, np.arange(len(ids)))] - np.arange(len(ids))
    at = np.flatnonzero(run >= block.shortest)
    if not len(at):
        return {}
    array = suffix_array(ids, at, len(block.vocab), block.longest)
    query, place = find_windows(np.concatenate([ids, np.zeros(block.longest + 1, dtype=np.int64)]), array, block)
    if not len(place):
        return {}
    edge = np.bincount(place, minlength=len(ids) + 1) - np.bincount(place + block.length[query], minlength=len(ids) + 1)
    hit = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]])
    step = np.diff(hit)
    spans = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))
    # longest match: windows that follow each other on one diagonal of one item
    order = np.lexsort((place, place - block.start[query]))
    diagonal, spot, own = (place - block.start[query])[order], place[order], query[order]
    fresh = np.concatenate([[True], (np.diff(diagonal) != 0) | (np.diff(spot) != 1)])
    group = np.cumsum(fresh) - 1
    reach = np.bincount(group) - 1 + block.length[own[fresh]]
    doc_of = lambda x: np.searchsorted(begin, x, side="right") - 1
    best: dict[int, int] = {}
    for d, r in zip(doc_of(spot[fresh]).tolist(), reach.tolist()):
        best[d] = max(best.get(d, 0), r)
    out = {d: ([], [], r) for d, r in best.items()}
    for a, b in spans:
        d = int(doc_of(a))
        out[d][0].append((a - int(begin[d]), b - int(begin[d])))
    pairs = np.unique(doc_of(place) * len(block.names) + block.owner[query])
    for p in pairs.tolist():
        out[p // len(block.names)][1].append(block.names[p % len(block.names)])
    return out


# as words_of() cuts
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[int, Iterator[ItemBlock]]:
    """Number of blocks, and the blocks, each made when it is asked for."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").cast("string").alias("t")).distinct()
    words = rows.agg(F.sum(F.regexp_count("t", F.lit(_WORD)).cast("long"))).first()[0] or 0
    count = max(1, -(-words // block_words))

    def block(items: DataFrame) -> ItemBlock:
        found = items.select("i", F.col("t").cast("binary").alias("t")).toLocalIterator()
        return ItemBlock([(r["i"], words_of(bytes(r["t"]) if r["t"] is not None else None)) for r in found], window)

    def blocks() -> Iterator[ItemBlock]:
        if count == 1:
            yield block(rows)
            return
        path = scratch_path(spark, "benchmark-blocks")
        dealt = rows.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(count)))
        dealt.repartition("b").write.partitionBy("b").parquet(path)
        stored = spark.read.schema("i string, t string, b long").parquet(path)
        for b in range(count):
            yield block(stored.filter(F.col("b") == b))

    return count, blocks()


def _shards(batches: Iterator[pa.RecordBatch], text: str, shard_words: int):
    """(batches, words of their documents) until a shard is full."""
    held, docs, n = [], [], 0
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        rows, cut = len(col), 0
        for i in range(rows):
            words = words_of(col[i].as_py())
            docs.append(words)
            n += len(words) + 1
            if n >= shard_words:
                yield [*held, batch.slice(cut, i + 1 - cut)], docs
                held, docs, n, cut = [], [], 0, i + 1
        if cut < rows:
            held.append(batch.slice(cut))
    if docs:
        yield held, docs


def _merged(spans: Column) -> Column:
    """Disjoint spans that cover what the given spans cover."""
    def add(acc, x):
        last = F.element_at(acc, -1)
        apart = (F.size(acc) == 0) | (x["start"] > F.try_element_at(acc, F.lit(-1))["end"])
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(apart, F.concat(acc, F.array(x))).otherwise(
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer)))

    return F.aggregate(F.array_sort(spans), F.slice(spans, 1, 0), add)


OVERLAP = ("row long, doc_id long, n_words long, hits array<struct<start:int,end:int>>, "
           "items array<string>, longest int")
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def overlap(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
            shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: n_words, hits (disjoint spans of words inside windows of
    test items), items (names with an occurring window), longest (words of
    the longest verbatim match of a window or more, else 0)."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))

    def scan(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for held, words in _shards(batches, "text", shard_words):
                found = match_shard(words, block.value)
                none = ([], [], 0)
                at = pa.Table.from_batches(held)
                hits = [[{"start": a, "end": b} for a, b in found.get(i, none)[0]] for i in range(len(words))]
                cols = [at["row"].combine_chunks(), at["doc_id"].combine_chunks(),
                        pa.array([len(w) for w in words], pa.int64()), pa.array(hits, _SPANS),
                        pa.array([found.get(i, none)[1] for i in range(len(words))], pa.list_(pa.string())),
                        pa.array([found.get(i, none)[2] for i in range(len(words))], pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "doc_id", "n_words", "hits", "items", "longest"])

        return rows.mapInArrow(run, OVERLAP)

    count, blocks = item_blocks(benchmark, window, block_words)
    if count == 1:
        return scan(sc.broadcast(next(blocks))).drop("row")
    rows = materialize(rows, "decontamination-rows")
    parts = []
    for block in blocks:
        shared = sc.broadcast(block)
        found = scan(shared)
        # every document once, then those with a hit
        parts.append(materialize(found if not parts else found.filter(F.size("hits") > 0), "decontamination-hits"))
        shared.destroy()
    union = reduce(DataFrame.unionByName, parts)
    merged = union.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.max("longest").alias("longest"))
    return merged.withColumn("hits", _merged(F.col("hits"))).drop("row")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents (all their columns) that hold no window of a test item."""
    sc = docs.sparkSession.sparkContext

    def cleaner(block, keep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for held, words in _shards(batches, "text", shard_words):
                found, at = match_shard(words, block.value), 0
                for batch in held:
                    yield batch.filter(pa.array([(at + i not in found) == keep for i in range(batch.num_rows)], pa.bool_()))
                    at += batch.num_rows
        return run

    count, blocks = item_blocks(benchmark, window, block_words)
    if count == 1:
        return docs.mapInArrow(cleaner(sc.broadcast(next(blocks)), True), docs.schema)
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("d")), "decontamination-rows")
    texts = rows.select("row", F.col("d.text").cast("string").alias("text"))
    hit = []
    for block in blocks:
        shared = sc.broadcast(block)
        hit.append(materialize(texts.mapInArrow(cleaner(shared, False), texts.schema).select("row"), "decontamination-hits"))
        shared.destroy()
    return rows.join(reduce(DataFrame.union, hit), "row", "left_anti").select("d.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op7: the overlap of every document with the benchmark."""
    from .common import table

    found = overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"), F.col("longest").cast("long").alias("longest_match"))
