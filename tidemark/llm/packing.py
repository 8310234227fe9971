"""Packing: shortest-pack-first over the histogram of piece lengths.

Documents become pieces of at most ``max_len`` ids (full pieces and one
rest). Only the histogram of piece lengths (at most ``max_len`` numbers)
reaches the driver, which packs *lengths*, longest first, each into the
shortest pack that still has room, updating counts of packing patterns. The
patterns then claim the pieces of each length by their rank.

Defined results: a null or empty text is one piece that holds just the end
id; repeated rows are packed each for itself; a null doc_id is carried as
null; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .tokens import default_tokenizer, encoder

MAX_LEN = 2048
END_ID = 1

PIECES = ("piece_id long, doc_id long, start long, length int, ids_crc32 long, "
          "doc_tokens long, ids binary")


@dataclass
class Slots:
    """Where the pieces of a length go, by rank: one entry per run of slots.

    Pieces of ``length`` with rank in [lo, lo + packs * copies) lie in packs
    ``first_pack + (rank - lo) % packs`` at ``offset + (rank - lo) // packs *
    length``. Entries are ordered by (length, lo). The table has at most
    2 * max_len patterns, whatever the number of documents.
    """

    length: np.ndarray
    lo: np.ndarray
    packs: np.ndarray
    first_pack: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (self.length.astype(np.int64) << 44) + self.lo
        i = np.searchsorted(key, (length.astype(np.int64) << 44) + rank, side="right") - 1
        within = rank - self.lo[i]
        return self.first_pack[i] + within % self.packs[i], self.offset[i] + within // self.packs[i] * length


def shortest_pack_first(histogram: dict[int, int], max_len: int = MAX_LEN) -> Slots:
    """Pack a histogram {length: count}, longest lengths first."""
    # a pattern: used length, number of packs, tuple of runs (length, copies)
    heap: list[tuple[int, int, int, tuple]] = []
    done: list[tuple[int, tuple]] = []
    serial = 0

    def put(used: int, packs: int, runs: tuple) -> None:
        nonlocal serial
        serial += 1
        heapq.heappush(heap, (used, serial, packs, runs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not heap or heap[0][0] + length > max_len:
                put(length, left, ((length, 1),))
                break
            used, _, packs, runs = heapq.heappop(heap)
            if left < packs:                       # split: some packs of the pattern stay as they were
                put(used, packs - left, runs)
                packs, copies = left, 1
            else:                                  # as many copies as keep it the shortest
                after = heap[0][0] if heap else max_len
                copies = min(left // packs, (max_len - used) // length, max(1, (after - used) // length))
            left -= packs * copies
            if runs[-1][0] == length:
                runs = (*runs[:-1], (length, runs[-1][1] + copies))
            else:
                runs = (*runs, (length, copies))
            used += length * copies
            if used == max_len:
                done.append((packs, runs))
            else:
                put(used, packs, runs)
    patterns = done + [(packs, runs) for _, _, packs, runs in heap]
    taken: dict[int, int] = {}
    rows, first = [], 0
    for packs, runs in patterns:
        offset = 0
        for length, copies in runs:
            lo = taken.get(length, 0)
            rows.append((length, lo, packs, first, offset))
            taken[length] = lo + packs * copies
            offset += length * copies
        first += packs
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return Slots(*cols)


def encode_pieces(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document with their ids (little-endian unsigned 32 bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        step = 4 * max_len
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for row, doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), enc.encode_all(batch.column(2))):
                ids += end
                for at in range(0, len(ids), step):
                    part = ids[at:at + step]
                    for col, v in zip(out, (row, doc, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part)):
                        col.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            cols = [pa.array(c, t) for c, t in zip(out, types)]
            yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in PIECES.split(", ")])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                       F.col("text").cast("string"))
    return rows.mapInArrow(run, PIECES)


def ranked(pieces: DataFrame) -> DataFrame:
    """Rank (from 0) of each piece among those of its length.

    The pieces of a length are dealt over salts, so a length that most
    documents share is ranked by many tasks; offsets of the salts come from
    a table of counts.
    """
    salts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("_salt", F.pmod(F.xxhash64("piece_id", "start"), F.lit(salts)))
    counts = dealt.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("length").orderBy("_salt")
    bases = counts.select("length", "_salt", (F.sum("_n").over(upto) - F.col("_n")).alias("_base"))
    within = Window.partitionBy("length", "_salt").orderBy("piece_id", "start")
    return (dealt.withColumn("_rank", F.row_number().over(within) - 1)
            .join(bases, ["length", "_salt"])
            .withColumn("rank", F.col("_base") + F.col("_rank"))
            .drop("_salt", "_base", "_rank"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, max_len: int = MAX_LEN,
                   end_id: int = END_ID) -> tuple[DataFrame, DataFrame]:
    """(pieces, places): the pieces with their ids, and per piece its place.

    places has piece_id, doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. The pieces are written to the shared folder once,
    as tokenising is by far the dearest step.
    """
    pieces = materialize(encode_pieces(docs, tokenizer or default_tokenizer(), max_len, end_id), "pieces")
    thin = pieces.drop("ids")
    histogram = {r["length"]: r["n"] for r in thin.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = docs.sparkSession.sparkContext.broadcast(shortest_pack_first(histogram, max_len))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            seq, off = slots.value.place(t["length"].to_numpy().astype(np.int64), t["rank"].to_numpy().astype(np.int64))
            t = t.drop_columns(["rank"]).append_column("sequence_id", pa.array(seq, pa.int64()))
            yield from t.append_column("offset", pa.array(off, pa.int64())).to_batches()

    cols = ["piece_id", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = ("piece_id long, doc_id long, start long, length int, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long")
    return pieces, ranked(thin).select(*cols, "rank").mapInArrow(place, schema)


def packed_sequences(pieces: DataFrame, places: DataFrame, max_len: int = MAX_LEN, pad_id: int = 0) -> DataFrame:
    """Real sequences: sequence_id, n_ids, and ``ids`` padded to max_len (bytes)."""
    placed = places.select("piece_id", "start", "sequence_id", "offset", "length").join(
        pieces.select("piece_id", "start", "ids"), ["piece_id", "start"])
    parts = placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_ids"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))),
                                 lambda x: F.hex(x["ids"])), "").alias("_hex"))
    pad = f"{int(pad_id):08x}"
    pad_le = "".join(reversed([pad[i:i + 2] for i in range(0, 8, 2)]))
    return parts.select("sequence_id", "n_ids",
                        F.unhex(F.rpad("_hex", max_len * 8, pad_le)).alias("ids"))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: the place of every piece of every document."""
    from .common import table

    _, places = pack_documents(table(spark, sf_dir, "documents"))
    return places.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                         "doc_tokens", "sequence_id", "offset")
