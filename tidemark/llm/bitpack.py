"""Token-id files: every id in the minimum number of bits of the vocabulary.

A table of token ids is a folder of shards in ascending doc_id order. A
shard is one Parquet file whose rows are *blocks*: whole documents until a
block holds ``BLOCK_IDS`` ids (a longer document is a block of its own). A
block carries its place in the shard, the place of each of its documents,
and one bit string: id number i lies in bits [i * bits, (i + 1) * bits),
lowest bit first. Parquet is only the container: it brings atomic commits
of tasks, so a lost executor never leaves half a shard, and block statistics
for random access; the ids themselves are in our bit string.

Defined results: a null or empty text is just the end id; repeated doc_ids
follow each other ordered by text; a null doc_id comes first; an empty
table writes an empty folder. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .tokens import default_tokenizer, encoder

BLOCK_IDS = 1 << 16
END_ID = 1

BLOCKS = ("shard int, block int, first long, n_ids long, bits int, payload binary, "
          "doc_ids array<long>, doc_offsets array<long>, doc_lengths array<long>")
_TYPES = {"shard": pa.int32(), "block": pa.int32(), "first": pa.int64(), "n_ids": pa.int64(), "bits": pa.int32(),
          "payload": pa.binary(), "doc_ids": pa.list_(pa.int64()), "doc_offsets": pa.list_(pa.int64()),
          "doc_lengths": pa.list_(pa.int64())}


def bits_for(vocab_size: int) -> int:
    """The least width that holds every id below vocab_size."""
    return max(1, int(vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out, step = [], BLOCK_IDS          # BLOCK_IDS * bits is a whole number of bytes
    for at in range(0, len(ids), step):
        plane = (ids[at:at + step, None].astype(np.uint32) >> np.arange(bits, dtype=np.uint32)) & 1
        out.append(np.packbits(plane.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack_bits(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """Ids [start, start + count) of a bit string, touching only their bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, dtype=f"<u{bits // 8}", count=count, offset=start * bits // 8).astype(np.uint32)
    at = (np.arange(start, start + count, dtype=np.int64) * bits)
    base = int(at[0] >> 3) if count else 0
    need = -(-((start + count) * bits) // 8) - base
    raw = np.zeros(need + 8, dtype=np.uint8)
    raw[:need] = np.frombuffer(payload, dtype=np.uint8, count=need, offset=base)
    byte, shift = (at >> 3) - base, (at & 7).astype(np.uint64)
    word = np.zeros(count, dtype=np.uint64)
    for k in range((bits + 14) // 8):
        word |= raw[byte + k].astype(np.uint64) << np.uint64(8 * k)
    return ((word >> shift) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode whole texts and write the shards below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        bits, shard = bits_for(enc.vocab_size), TaskContext.get().partitionId()
        first = block = 0
        held: list[bytes] = []
        index: list[tuple[int, int, int]] = []
        n = 0

        def flush():
            nonlocal first, block, held, index, n
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            row = (shard, block, first, n, bits, pack_bits(ids, bits), *map(list, zip(*index)))
            first, block, held, index, n = first + n, block + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES.values())], names=list(_TYPES))

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), enc.encode_all(batch.column(1))):
                ids += end
                if n and n + len(ids) // 4 > BLOCK_IDS:
                    yield flush()
                index.append((doc, n, len(ids) // 4))
                held.append(ids)
                n += len(ids) // 4
        if n:
            yield flush()

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """Ids before each shard: one row per shard (as many as writing tasks)."""
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    return totals.select("shard", (F.sum("_n").over(Window.orderBy("shard")) - F.col("_n")).alias("shard_start"))


def read_documents(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32, and the ids themselves unless ``digest_only``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ids = unpack_bits(b["payload"], b["bits"], 0, b["n_ids"]).astype("<u4")
                parts = [ids[o:o + n] for o, n in zip(b["doc_offsets"], b["doc_lengths"])]
                cols = [pa.array([b["shard"]] * len(parts), pa.int32()), pa.array(b["doc_ids"], pa.int64()),
                        pa.array([b["first"] + o for o in b["doc_offsets"]], pa.int64()),
                        pa.array(b["doc_lengths"], pa.int64()),
                        pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())]
                names = ["shard", "doc_id", "_first", "n_tokens", "ids_crc32"]
                if not digest_only:
                    cols.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    blocks = read_blocks(spark, path)
    schema = "shard int, doc_id long, _first long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids array<int>")
    rows = blocks.mapInArrow(run, schema).join(shard_starts(blocks), "shard")
    keep = ["n_tokens", "ids_crc32"] + ([] if digest_only else ["ids"])
    return rows.select("doc_id", (F.col("shard_start") + F.col("_first")).alias("start"), *keep)


def read_range(spark: SparkSession, path: str, lo: int, hi: int) -> np.ndarray:
    """Random access: ids [lo, hi) of the whole corpus; reads only the blocks
    that hold them. The caller bounds hi - lo."""
    blocks = read_blocks(spark, path)
    at = F.col("shard_start") + F.col("first")
    hit = (blocks.join(shard_starts(blocks), "shard").filter((at < hi) & (at + F.col("n_ids") > lo))
           .select(at.alias("at"), "n_ids", "bits", "payload").orderBy("at").collect())
    parts = [unpack_bits(r["payload"], r["bits"], max(0, lo - r["at"]),
                         min(hi - r["at"], r["n_ids"]) - max(0, lo - r["at"])) for r in hit]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: write the files of all documents, read them back, digest them."""
    from .common import table

    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, default_tokenizer())
    return read_documents(spark, path, digest_only=True).select("doc_id", "start", "n_tokens", "ids_crc32")
