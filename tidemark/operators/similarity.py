"""Cosine search for many targets at once: exact, and through a hash index.

Vectors are normalised once. In the exact search the targets lie in blocks and
the rows in groups; every block meets every group in one cogrouped task, which
multiplies two small matrices and gives out only each target's best ``k``.
Every task holds one block and one group, whatever the size of the table.

The index is locality-sensitive hashing with one table: the signs of a few
random projections are a row's cell, so every row lies in exactly one. A
target looks into its most likely cells, those whose sign changes cost the
least squared distance to the planes. How many are needed is measured, not
guessed: the exact neighbours of a bounded number of targets say in which of
a target's cells they lie, and ``recall`` of them must be inside. Cells larger
than a group are cut into several, all of which are looked into.

Rows without an id or a vector, with a null or non-finite component, or of
length zero are left out (they have no direction); equal similarities are
ordered by id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..session import scratch_path

BLOCK, GROUP = 1024, 32_768
#: Targets from which the number of cells to look into is learned.
SAMPLE = 256

_UNIT = "id long, unit array<double>"
_BEST = "target_id long, id long, sim double"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unit_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, unit): vectors of length one."""
    vec = F.col(vec_col).cast("array<double>")
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    return (rows.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
            .filter(F.col("id").isNotNull() & F.col("vec").isNotNull()).filter(whole)
            .withColumn("length", length).filter("length > 0")
            .select("id", F.transform("vec", lambda x: x / F.col("length")).alias("unit")))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    lists = column.combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), dim))
    out[np.arange(dim) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _meet(targets: DataFrame, rows: DataFrame, keys: list[str], k: int, dim: int) -> DataFrame:
    """Each target's best k rows in every (cogrouped) group that it meets."""

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        tid, rid = left["id"].to_numpy(), right["id"].to_numpy()
        out: list[list[np.ndarray]] = [[], [], []]
        if len(tid) and len(rid):
            order = np.argsort(rid, kind="stable")          # ties: least id
            rid, m, v = rid[order], _matrix(right["unit"], dim)[order], _matrix(left["unit"], dim)
            for a in range(0, len(tid), 256):
                sim = v[a:a + 256] @ m.T
                sim[tid[a:a + 256, None] == rid] = -np.inf     # not the target itself
                most = min(k, len(rid))
                least = np.partition(sim, len(rid) - most, axis=1)[:, len(rid) - most]
                i, j = np.nonzero((sim >= least[:, None]) & (sim > -np.inf))
                for col, x in zip(out, (tid[a + i], rid[j], sim[i, j])):
                    col.append(x)
        cols = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table({"target_id": pa.array(cols[0].astype(np.int64)), "id": pa.array(cols[1].astype(np.int64)),
                         "sim": pa.array(cols[2].astype(np.float64))})

    return targets.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(best, _BEST)


def _top(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("target_id").orderBy(F.desc("sim"), "id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def _dealt(df: DataFrame, name: str, size: int, n: int) -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // size)))).cast("int"))


def _exact(rows: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    n, dim = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("unit")), F.lit(1))).first()
    n_targets = targets.count()
    blocks, groups = max(1, -(-n_targets // BLOCK)), max(1, -(-n // GROUP))
    left = _dealt(targets, "b", BLOCK, n_targets).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = _dealt(rows, "g", GROUP, n).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return _top(_meet(left, right, ["b", "g"], k, dim), k)


def _result(best: DataFrame, digits: int) -> DataFrame:
    return best.select("target_id", "rank", "id", half_up("sim", digits).alias("cosine_similarity"))


def cosine_topk_all(vectors: DataFrame, targets: DataFrame, id_col: str, vec_col: str, k: int = 10,
                    digits: int = 6) -> DataFrame:
    """(target_id, rank, id, cosine_similarity): the k best rows of ``vectors``
    for every row of ``targets`` (same columns), the target itself excluded."""
    rows = _written(unit_vectors(vectors, id_col, vec_col), "unit-vectors")
    wanted = _written(unit_vectors(targets, id_col, vec_col), "unit-targets")
    return _result(_exact(rows, wanted, k), digits)


# ---------------------------------------------------------------- the index
@dataclass
class CosineIndex:
    """Rows with their cells, and what a search needs to know."""

    rows: DataFrame              # id, unit, cell
    sizes: DataFrame             # cell, n: at most 2^bits rows
    planes: np.ndarray           # dim x bits
    dim: int


def _signs(v: np.ndarray, planes: np.ndarray) -> np.ndarray:
    return ((v @ planes > 0) << np.arange(planes.shape[1])).sum(axis=1)


def _likely_cells(v: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Per vector all cells, likeliest first (targets x 2^bits)."""
    bits = planes.shape[1]
    margin = (v @ planes) ** 2
    own = _signs(v, planes)
    flips = np.arange(1 << bits)
    cost = margin @ ((flips[:, None] >> np.arange(bits)) & 1).T
    return own[:, None] ^ flips[np.argsort(cost, axis=1, kind="stable")]


def build_index(vectors: DataFrame, id_col: str, vec_col: str, cell_rows: int = 4096, most_bits: int = 12, seed: int = 7) -> CosineIndex:
    """Every row into its cell; about ``cell_rows`` rows a cell, 2^most_bits cells at most."""
    unit = _written(unit_vectors(vectors, id_col, vec_col), "unit-vectors")
    n, dim = unit.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("unit")), F.lit(1))).first()
    bits = min(most_bits, max(2, math.ceil(math.log2(max(1, n / cell_rows)))))
    planes = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, max(bits, 1))))[0][:, :bits] if dim >= bits else \
        np.random.default_rng(seed).normal(size=(dim, bits))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            yield from t.append_column("cell", pa.array(_signs(_matrix(t["unit"], dim), planes).astype(np.int32))).to_batches()

    rows = _written(unit.mapInArrow(cells, f"{_UNIT}, cell int"), "cosine-index")
    return CosineIndex(rows, rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), planes, dim)


def probes_for(index: CosineIndex, targets: DataFrame, k: int, recall: float, sample: int = SAMPLE) -> int:
    """The number of likely cells that hold the share ``recall`` of the exact
    neighbours of about ``sample`` targets (drawn by a hash of the id)."""
    n = targets.count()
    drawn = targets.filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < (sample * 1.0 / max(n, 1)) * (1 << 30)) if n > sample else targets
    drawn = _written(drawn, "drawn-targets")
    near = _exact(index.rows.select("id", "unit"), drawn, k).join(index.rows.select("id", "cell"), "id")
    wanted = drawn.withColumnRenamed("id", "target_id").join(
        near.groupBy("target_id").agg(F.collect_list("cell").alias("cells")), "target_id").select("unit", "cells")
    planes, dim = index.planes, index.dim

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = _likely_cells(_matrix(pa.chunked_array([batch.column(0)]), dim), planes)
            place = np.argsort(order, axis=1)
            at = [p for row, cells in zip(place, batch.column(1).to_pylist()) for p in row[cells].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32())], names=["place"])

    found = wanted.mapInArrow(places, "place int").groupBy("place").count().orderBy("place").collect()   # 2^bits rows at most
    need, seen = recall * sum(r["count"] for r in found), 0
    for r in found:
        seen += r["count"]
        if seen >= need:
            return r["place"] + 1
    return 1


def index_topk(index: CosineIndex, targets: DataFrame, id_col: str, vec_col: str, k: int = 10, digits: int = 6,
               recall: float = 0.95, probes: int | None = None) -> DataFrame:
    """As ``cosine_topk_all``, from the likely cells of each target only."""
    wanted = _written(unit_vectors(targets, id_col, vec_col), "unit-targets")
    probes = probes or probes_for(index, wanted, k, recall)
    planes, dim = index.planes, index.dim

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, (1 << 20) // (1 << planes.shape[1]))
            for a in range(0, batch.num_rows, step):
                t = pa.Table.from_batches([batch.slice(a, step)])
                cells = _likely_cells(_matrix(t["unit"], dim), planes)[:, :probes]
                yield from t.append_column("cells", pa.array(cells.astype(np.int32).tolist(), pa.list_(pa.int32()))).to_batches()

    looked = wanted.mapInArrow(look, f"{_UNIT}, cells array<int>").select("id", "unit", F.explode("cells").alias("cell"))
    cuts = index.sizes.select("cell", F.ceil(F.col("n") / GROUP).cast("int").alias("cuts"))     # 2^bits rows at most
    left = looked.join(F.broadcast(cuts), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    right = index.rows.join(F.broadcast(cuts), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"))
    # targets of a cell in blocks, too: a cell that all targets look into is many tasks
    n_targets = wanted.count()
    blocks = max(1, -(-n_targets // (8 * BLOCK)))
    left = _dealt(left, "b", 8 * BLOCK, n_targets)
    right = right.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["cell", "part", "b"]
    return _result(_top(_meet(left.select(*keys, "id", "unit"), right.select(*keys, "id", "unit"), keys, k, dim), k), digits)
