"""Hard-negative mining with bounds along a spanning tree of the anchors.

A row's score for an anchor is their inner product after every component x
became floor(256 x). Anchors lie in blocks, near ones together, and every
block has a minimum spanning tree. A candidate's score at an anchor lies
within (edge length) * (candidate's norm) of its score at the anchor's parent
(Cauchy-Schwarz), so bounds go down the tree from the root, which is scored
for all. Where a candidate's bounds meet the window in which it could still
matter, it is scored exactly, and its bounds begin afresh from there; where
they don't, it is passed over.

Two searches go through the same tasks: each anchor's best rows of its own
label (window: its worst kept score and above), then, per positive, the best
rows of other labels inside the share of the positive's score (window: from
the worst kept or the least share to the largest share). A task holds one
block of anchors and streams one group of candidates past it; every block
meets every group once, nothing passes through the driver, and only the best
few of each (anchor, group) leave a task.

Defined results: rows without a label, a vector or a vec_id, or with a null
or non-finite component, take no part; repeated rows count each for itself;
equal scores are ordered by vec_id, then by row; a shorter vector counts as
followed by zeros; an empty vector scores zero; scaled components are held
within +-sqrt(2^63 / dimension), so scores fit 64 bits; an empty table, or
one without anchors, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, numbered

#: Anchors of a block (one tree), and candidates that one task takes at least
#: and at most, where there are as many.
ANCHORS = 4096
FEWEST, MOST = 4096, 1 << 20
#: Anchors x candidates whose bounds are held at once.
CELLS = 1 << 21
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = (50, 100), (95, 100)

ROW = "uid long, vec_id long, label int, vec array<double>"


def vectors(rows: DataFrame, label: Column) -> DataFrame:
    """Rows that take part: uid, vec_id, label and the vector's components."""
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
                        label.cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("vec"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).filter(whole))


def scaled(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of whole numbers, padded with zeros to ``dim``."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dim))
    out[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    most = float(math.isqrt((1 << 63) // max(dim, 1)) >> 1)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(256.0 * out), -most, most)


# ------------------------------------------------------------ spanning tree
def spanning_tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, depth) of a minimum spanning tree: ``order`` lists the
    rows by depth; parent and depth go with that order, parents as places in it."""
    n = len(v)
    square = (v * v).sum(axis=1)
    best, parent, depth = np.full(n, np.inf), np.full(n, -1), np.zeros(n, dtype=np.int64)
    left, at = np.ones(n, dtype=bool), 0
    for _ in range(n - 1):
        left[at] = False
        length = square + square[at] - 2 * (v @ v[at])
        closer = left & (length < best)
        best[closer], parent[closer] = length[closer], at
        at = int(np.argmin(np.where(left, best, np.inf)))
        if parent[at] < 0:                                   # lengths beyond the range of a double
            parent[at] = 0
        depth[at] = depth[parent[at]] + 1
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    up = parent[order]
    return order, np.where(up < 0, -1, place[up]), depth[order]


TREE = f"block long, place int, parent int, depth int, edge double, {ROW}"


def trees(table: DataFrame, is_anchor: Column, dim: int, size: int = ANCHORS) -> DataFrame:
    """The anchors in blocks, each with its tree. Anchors are dealt to blocks in
    the order of the signs of a few fixed random projections, so that near ones
    share a block and edges are short."""
    planes = np.random.default_rng(13).normal(size=(dim, 16))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = ((scaled(batch.column(3), dim) @ planes > 0) << np.arange(16)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code.astype(np.int64)), pa.array(np.zeros(len(code), dtype=np.int64))],
                                             names=[*batch.schema.names, "code", "all"])

    def grow(block: pa.Table) -> pa.Table:
        v = scaled(block["vec"].combine_chunks(), dim)
        order, parent, depth = spanning_tree(v)
        v = v[order]
        edge = np.where(parent < 0, 0.0, np.sqrt(((v - v[parent]) ** 2).sum(axis=1)))
        block = block.take(pa.array(order))
        return pa.table({"block": block["block"], "place": pa.array(np.arange(len(order)), pa.int32()), "parent": pa.array(parent, pa.int32()),
                         "depth": pa.array(depth, pa.int32()), "edge": pa.array(edge), **{c: block[c] for c in ("uid", "vec_id", "label", "vec")}})

    coded_rows = table.filter(is_anchor).mapInArrow(coded, f"{ROW}, code long, all long")
    blocks = numbered(coded_rows, "all", ["code", "vec_id", "uid"]).withColumn("block", F.expr(f"index div {size}"))
    return materialize(blocks.select("block", "uid", "vec_id", "label", "vec").groupBy("block").applyInArrow(grow, TREE), "anchor-trees")


# ------------------------------------------------------------- inside a task
class Best:
    """The best ``k`` (score, vec_id, uid) of every slot, with a floor below
    which a score no longer matters."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.floor = np.full(slots, -np.inf)
        self.rows = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))        # slot, score, vec_id, uid

    def add(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        slot, score, vec_id, uid = (np.concatenate(x) for x in zip(self.rows, (slot, score, vec_id, uid)))
        order = np.lexsort((uid, vec_id, -score, slot))
        slot = slot[order]
        first = np.searchsorted(slot, slot, side="left")
        kept = np.arange(len(slot)) - first < self.k
        order, slot = order[kept], slot[kept]
        self.rows = (slot, score[order], vec_id[order], uid[order])
        full = np.flatnonzero(np.bincount(slot, minlength=len(self.floor)) == self.k)
        self.floor[full] = self.rows[1][np.searchsorted(slot, full, side="right") - 1]


def share(score: np.ndarray, part: tuple[int, int], up: bool) -> np.ndarray:
    """score * part as a whole number, rounded up or down, without overflow."""
    whole, rest = np.divmod(score, part[1])
    return whole * part[0] + (-(-rest * part[0] // part[1]) if up else rest * part[0] // part[1])


class Block:
    """A block of anchors with its tree and what was found for them so far."""

    def __init__(self, rows: pa.Table, dim: int, k: int):
        self.v = scaled(rows["vec"].combine_chunks(), dim)
        self.parent, self.depth = (rows[c].to_numpy().astype(np.int64) for c in ("parent", "depth"))
        self.edge = rows["edge"].to_numpy()
        self.uid, self.vec_id, self.label = (rows[c].to_numpy().astype(np.int64) for c in ("uid", "vec_id", "label"))
        self.norm = np.sqrt((self.v * self.v).sum(axis=1))
        self.most = np.abs(self.v).max(initial=0.0)
        self.levels = np.flatnonzero(np.diff(self.depth, prepend=-1)).tolist() + [len(self.v)]
        self.best = Best(len(self.v), k)

    def window(self) -> tuple[np.ndarray, np.ndarray]:
        return self.best.floor, np.full(len(self.v), np.inf)

    def matters(self, anchors: slice, label: np.ndarray, uid: np.ndarray) -> np.ndarray:
        return (self.label[anchors, None] == label) & (self.uid[anchors, None] != uid)

    def take(self, anchor: np.ndarray, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        on = score >= self.best.floor[anchor]
        self.best.add(anchor[on], score[on], vec_id[on], uid[on])

    def found(self) -> dict:
        slot, score, vec_id, uid = self.best.rows
        return {"anchor_uid": self.uid[slot], "anchor_id": self.vec_id[slot], "score": score, "found_id": vec_id, "found_uid": uid}

    def scan(self, x: np.ndarray, vec_id: np.ndarray, label: np.ndarray, uid: np.ndarray) -> int:
        """Take a few candidates past all anchors, parents first; returns how
        many exact scores were needed."""
        exact = self.most * np.abs(x).max(initial=0.0) * max(1, x.shape[1]) < 2.0 ** 53
        v, x_ = (self.v, x) if exact else (self.v.astype(np.int64), x.astype(np.int64))
        length = np.sqrt((x * x).sum(axis=1))
        lo, hi = np.empty((len(v), len(x))), np.empty((len(v), len(x)))
        floor, roof = self.window()
        hits, scored = [], 0
        for a, b in zip(self.levels, self.levels[1:]):
            at = slice(a, b)
            counts = self.matters(at, label, uid)
            if a == 0:                                       # the root is scored for all
                want = np.ones((b, len(x)), dtype=bool)
            else:
                # a little more than the bound, for rounding
                reach = self.edge[at, None] * length * (1 + 1e-9) + 1e-12 * self.norm[at, None] * length + 1e-6
                lo[at], hi[at] = lo[self.parent[at]] - reach, hi[self.parent[at]] + reach
                want = counts & (hi[at] >= floor[at, None]) & (lo[at] <= roof[at, None])
            i, j = np.nonzero(want)
            scored += len(i)
            if 4 * len(i) > want.size:
                score = (v[at] @ x_.T)[i, j]
            else:
                score = np.concatenate([(v[i[k:k + 65536] + a] * x_[j[k:k + 65536]]).sum(axis=1) for k in range(0, len(i), 65536)] or [np.zeros(0)])
            lo[i + a, j] = hi[i + a, j] = score
            on = counts[i, j]
            hits.append((i[on] + a, j[on], score[on].astype(np.int64)))
        i, j, score = (np.concatenate(c) for c in zip(*hits))
        self.take(i, score, vec_id[j], uid[j])
        return scored


class WindowBlock(Block):
    """Anchors with their positives; looks for negatives inside their windows."""

    def __init__(self, rows: pa.Table, dim: int, k: int, low: tuple[int, int], high: tuple[int, int]):
        super().__init__(rows, dim, k)
        lists = rows["positives"].combine_chunks()
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        self.per = max(1, int(sizes.max(initial=0)))
        flat = lists.flatten()
        self.positive = {name: flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k, name in enumerate(("score", "found_id", "found_uid"))}
        self.first = np.cumsum(sizes) - sizes
        self.sizes = sizes
        score = self.positive["score"]
        slots = np.repeat(np.arange(len(sizes)) * self.per - self.first, sizes) + np.arange(len(score))
        self.low, self.high = np.full(len(sizes) * self.per, np.inf), np.full(len(sizes) * self.per, -np.inf)
        self.low[slots], self.high[slots] = share(score, low, up=True), share(score, high, up=False)
        self.best = Best(len(sizes) * self.per, k)

    def window(self) -> tuple[np.ndarray, np.ndarray]:
        open_ = self.low <= self.high
        floor = np.where(open_, np.maximum(self.low, self.best.floor), np.inf)
        return (floor.reshape(-1, self.per).min(axis=1), np.where(open_, self.high, -np.inf).reshape(-1, self.per).max(axis=1))

    def matters(self, anchors: slice, label: np.ndarray, uid: np.ndarray) -> np.ndarray:
        return self.label[anchors, None] != label

    def take(self, anchor: np.ndarray, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        for k in range(self.per):
            slot = anchor * self.per + k
            on = (score >= np.maximum(self.low[slot], self.best.floor[slot])) & (score <= self.high[slot])
            self.best.add(slot[on], score[on], vec_id[on], uid[on])

    def found(self) -> dict:
        slot, score, vec_id, uid = self.best.rows
        anchor = slot // self.per
        at = self.first[anchor] + slot % self.per
        return {"anchor_uid": self.uid[anchor], "anchor_id": self.vec_id[anchor], "positive_score": self.positive["score"][at],
                "positive_id": self.positive["found_id"][at], "positive_uid": self.positive["found_uid"][at],
                "score": score, "found_id": vec_id, "found_uid": uid}


# ---------------------------------------------------------------- the search
def _search(anchors: DataFrame, table: DataFrame, blocks: int, groups: int, dim: int, make, schema: str) -> DataFrame:
    """Every block of anchors against every group of candidates, one pair a time."""
    extra = [c for c in anchors.columns if c not in TREE]
    none = [F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in ("place", "parent", "depth", "edge")]
    cols = ["block", "grp", "kind", "place", "parent", "depth", "edge", "uid", "vec_id", "label", "vec", *extra]
    left = anchors.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("kind", F.lit(0)).select(*cols)
    right = (table.withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
             .select("block", "grp", F.lit(1).alias("kind"), *none, "uid", "vec_id", "label", "vec",
                     *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in extra]))
    most = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (left.unionByName(right).repartition(max(1, min(blocks * groups, 4 * most)), "block", "grp")
             .sortWithinPartitions("block", "grp", "kind", "place", "vec_id", "uid"))
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None

        def done():
            found = block.found()
            return pa.RecordBatch.from_arrays([pa.array(found[n]) for n in names], names=names)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            tags = np.stack([t[c].to_numpy().astype(np.int64) for c in ("block", "grp", "kind")], axis=1)
            cuts = np.flatnonzero((np.diff(tags, axis=0, prepend=-1) != 0).any(axis=1)).tolist() + [len(tags)]
            for a, b in zip(cuts, cuts[1:]):
                if tuple(tags[a, :2]) != key:
                    if block is not None:
                        yield done()
                    key, held, block = tuple(tags[a, :2]), [], None
                part = t.slice(a, b - a)
                if tags[a, 2] == 0:
                    held.append(part)
                    continue
                if block is None and held:
                    block, held = make(pa.concat_tables(held), dim), []
                if block is not None:
                    x = scaled(part["vec"].combine_chunks(), dim)
                    ids = [part[c].to_numpy().astype(np.int64) for c in ("vec_id", "label", "uid")]
                    step = max(64, min(4096, CELLS // len(block.v)))
                    for k in range(0, len(x), step):
                        block.scan(x[k:k + step], *(c[k:k + step] for c in ids))
        if block is not None:
            yield done()

    return dealt.mapInArrow(run, schema)


def mine(table: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: tuple[int, int] = LOW, high: tuple[int, int] = HIGH, block: int = ANCHORS) -> DataFrame:
    """Per anchor, positive and rank: the negative and both scores.

    ``table`` has uid, vec_id, label and vec (see ``vectors``). Positive and
    negative scores are at most the shares ``low`` and ``high`` apart.
    """
    spark = table.sparkSession
    table = materialize(table, "vectors")
    n, n_anchors, dim = table.agg(F.count(F.lit(1)), F.count_if(is_anchor), F.max(F.size("vec"))).first()
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not n_anchors:
        return spark.createDataFrame([], schema)
    blocks = -(-n_anchors // block)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(-(-n // MOST), min(-(-tasks // blocks), -(-n // FEWEST)))
    tree = trees(table, is_anchor, dim, block)

    near = _search(tree, table, blocks, groups, dim, lambda rows, d: Block(rows, d, positives),
                   "anchor_uid long, anchor_id long, score long, found_id long, found_uid long")
    by = Window.partitionBy("anchor_uid").orderBy(F.desc("score"), "found_id", "found_uid")
    best = (materialize(near, "near").withColumn("r", F.row_number().over(by)).filter(F.col("r") <= positives)
            .groupBy(F.col("anchor_uid").alias("uid")).agg(F.collect_list(F.struct("score", "found_id", "found_uid")).alias("positives")))
    tree = materialize(tree.join(best, "uid", "left"), "anchors")

    hard = _search(tree, table, blocks, groups, dim, lambda rows, d: WindowBlock(rows, d, negatives, low, high),
                   "anchor_uid long, anchor_id long, positive_score long, positive_id long, positive_uid long, score long, found_id long, found_uid long")
    by = Window.partitionBy("anchor_uid", "positive_uid").orderBy(F.desc("score"), "found_id", "found_uid")
    return (materialize(hard, "hard").withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def query(spark, sf_dir: str) -> DataFrame:
    """op13: hard negatives of every 50th vector, with every 7th label moved on by one."""
    from .common import table

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors(table(spark, sf_dir, "embeddings"), moved), F.col("vec_id") % 50 == 0)
