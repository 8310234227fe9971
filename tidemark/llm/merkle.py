"""Merkle manifest of a data set: postorder append logs of ternary hash trees.

Every source is a tree over its documents in ascending doc_id, and the roots
of the sources are the leaves of one more tree. While several nodes remain,
every three consecutive ones (the last run: fewer, even one) become the hash
of their digests.

A tree is cut into aligned blocks of 3^LEVELS leaves. One builder takes a
block and appends its nodes in the order in which they are completed: a
parent directly follows its last child. Block roots are the leaves of the
next tier, so a tree of any size takes a few passes, each over 3^LEVELS
times fewer rows, and no task ever holds more than one block. Where a node
lies in a log follows from subtree sizes alone (``postorder``), so siblings
are addressed, never searched.

Defined results: nulls are hashed as ``-``; a null source is a tree of its
own, the first; null doc_ids come first; repeated doc_ids are ordered by
their leaf, repeated rows are leaves of their own; empty and very long texts
are hashed like any other; an empty table has no trees and gives no rows.
Columns other than the five hashed ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered

ARITY = 3
#: Levels of a block: 729 leaves, at most 1,093 nodes, 35 kB.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

LOG = "tree string, block long, whole boolean, n int, names array<string>, claims array<binary>, nodes binary, top binary"
PATHS = "tree string, block long, name string, subroot binary, path binary, root binary"


# ------------------------------------------------------------ closed forms
def completed(i: int) -> int:
    """Nodes that are complete before leaf ``i`` is appended."""
    total = i
    while i := i // ARITY:
        total += i
    return total


def postorder(level: int, j: int, n: int) -> int:
    """Place of node j of a level in the log of a tree of n leaves: after its
    last leaf come that leaf's ancestors, one a level."""
    last = min((j + 1) * ARITY ** level, n) - 1
    return completed(last) + level


def width(level: int, n: int) -> int:
    """Nodes on a level over n leaves."""
    return -(-n // ARITY ** level)


def height(n: int) -> int:
    """Levels above the leaves until one node remains."""
    level = 0
    while width(level, n) > 1:
        level += 1
    return level


def siblings(i: int, n: int, levels: int) -> list[tuple[list[int], list[int]]]:
    """Per level, the log places of the siblings left and right of the
    ancestor of leaf ``i``."""
    out = []
    for level in range(levels):
        own = i // ARITY ** level
        first = own - own % ARITY
        end = min(first + ARITY, width(level, n))
        out.append(([postorder(level, j, n) for j in range(first, own)],
                    [postorder(level, j, n) for j in range(own + 1, end)]))
    return out


# --------------------------------------------------------- inside one task
def join_hash(digests: list[bytes]) -> bytes:
    """Hash of the concatenated hex texts of digests."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def append_log(leaves: list[bytes], levels: int) -> list[bytes]:
    """All nodes of a block in completion order."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def put(level: int, digest: bytes) -> None:
        log.append(digest)
        waiting[level].append(digest)

    def close(level: int) -> None:
        done, waiting[level] = waiting[level], []
        put(level + 1, join_hash(done))

    for leaf in leaves:
        put(0, leaf)
        level = 0
        while level < levels and len(waiting[level]) == ARITY:
            close(level)
            level += 1
    for level in range(levels):
        if waiting[level]:
            close(level)
    return log


def _cut(nodes: bytes) -> list[bytes]:
    return [nodes[k:k + 32] for k in range(0, len(nodes), 32)]


def _levels(row: dict, levels: int) -> int:
    """A whole tree ends with one node; other blocks rise to the next tier."""
    return height(row["n"]) if row["whole"] else levels


def _packed(path: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    """A path as bytes: per level the numbers of left and right siblings, then these."""
    return b"".join(bytes((len(left), len(right))) + b"".join(left) + b"".join(right) for left, right in path)


def unpacked(path: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    out, at = [], 0
    while at < len(path):
        left, right = path[at], path[at + 1]
        digests = _cut(path[at + 2:at + 2 + 32 * (left + right)])
        out.append((digests[:left], digests[left:]))
        at += 2 + 32 * (left + right)
    return out


def fold(digest: bytes, path: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    """The root that a digest and its siblings give."""
    for left, right in path:
        digest = join_hash([*left, digest, *right])
    return digest


def _block_paths(row: dict, levels: int) -> Iterator[list[tuple[list[bytes], list[bytes]]]]:
    """Per leaf of a block, its siblings, taken from the log by their places."""
    nodes = _cut(row["nodes"])
    for i in range(row["n"]):
        yield [([nodes[k] for k in left], [nodes[k] for k in right]) for left, right in siblings(i, row["n"], _levels(row, levels))]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One block at a time: a block is a few dozen kilobytes."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(),
             "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types[t]) for n, t in fields], names=[n for n, _ in fields])


# ---------------------------------------------------------------- the logs
def leaf_digest(text: Column | None = None) -> Column:
    """Hash of a document's fields, each with its length in bytes."""
    parts = []
    for name in FIELDS:
        value = (text if name == "text" and text is not None else F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def leaves(docs: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """Leaf digests (tree, name, leaf, claim), without the texts. ``claim`` is
    the leaf of what someone holds instead (``claimed_text``), to be verified."""
    claim = F.lit(None).cast("binary") if claimed_text is None else leaf_digest(claimed_text)
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))     # null first
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("key"), F.col("doc_id").cast("string").alias("name"),
                       leaf_digest().alias("leaf"), claim.alias("claim"), F.monotonically_increasing_id().alias("row"))


def _tier(nodes: DataFrame, name: str, levels: int) -> DataFrame:
    """One row per aligned block of (tree, index, name, leaf, claim): its log."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in _rows(batch):
                members = row["members"]
                row["n"], row["names"] = len(members), [m["name"] for m in members]
                row["claims"] = [m["claim"] for m in members]
                log = append_log([m["leaf"] for m in members], _levels(row, levels))
                row["nodes"], row["top"] = b"".join(log), log[-1]
                out.append(row)
            yield _batch(out, LOG)

    size = ARITY ** levels
    blocks = (nodes.withColumn("block", F.expr(f"index div {size}")).groupBy("tree", "block", "total").agg(
        F.array_sort(F.collect_list(F.struct("index", "name", "leaf", "claim"))).alias("members"))
        .select("tree", "block", (F.col("total") <= size).alias("whole"), "members"))
    return materialize(blocks.mapInArrow(run, LOG), name)


def tiers(nodes: DataFrame, name: str, levels: int = LEVELS) -> list[DataFrame]:
    """Logs of all trees of (tree, index, total, name, leaf, claim), lowest
    tier first. The loop ends with the tier at which the largest tree is whole."""
    out = [_tier(nodes, name, levels)]
    while out[-1].filter("not whole").limit(1).count():
        below = out[-1].filter("not whole")
        total = F.count(F.lit(1)).alias("total")
        tops = below.select("tree", F.col("block").alias("index"), F.lit(None).cast("string").alias("name"),
                            F.col("top").alias("leaf"), F.lit(None).cast("binary").alias("claim"))
        out.append(_tier(tops.join(below.groupBy("tree").agg(total), "tree"), name, levels))
    return out


@dataclass
class Manifest:
    """The written logs: those of the sources' trees and those of the tree over them."""

    documents: list[DataFrame]
    sources: list[DataFrame]
    levels: int


def build(leaf_rows: DataFrame, levels: int = LEVELS) -> Manifest:
    """Write the logs of all trees of ``leaves``."""
    docs = tiers(numbered(materialize(leaf_rows, "leaves"), "tree", ["key", "leaf", "row"]), "merkle-log", levels)
    subroots = docs[0].filter("whole")
    for tier in docs[1:]:
        subroots = subroots.unionByName(tier.filter("whole"))
    over = materialize(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("leaf"),
                                       F.lit(None).cast("binary").alias("claim")), "subroots")
    return Manifest(docs, tiers(numbered(over, "tree", ["name"]), "merkle-sources", levels), levels)


# -------------------------------------------------------------- the proofs
def _expanded(logs: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """Paths of all leaves of the blocks, given the paths of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                leaf_at = _cut(row["nodes"])
                yield _batch([{"tree": row["tree"], "block": row["block"] * ARITY ** levels + i, "name": row["names"][i],
                               # only the leaves of the lowest tier have names
                               "subroot": row["subroot"] or (leaf_at[postorder(0, i, row["n"])] if row["names"][i] else None),
                               "path": _packed(path) + row["path"], "root": row["root"]}
                              for i, path in enumerate(_block_paths(row, levels))], PATHS)

    return logs.join(above.drop("name"), ["tree", "block"]).mapInArrow(run, PATHS)


def _paths(logs: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Paths of the blocks of the lowest tier; ``tops`` has those of whole trees."""
    above = None
    for k in range(len(logs) - 1, -1, -1):
        own = logs[k].filter("whole").select("tree", "block").join(tops.drop("block"), "tree").select(*[c.split()[0] for c in PATHS.split(", ")])
        above = materialize(own if above is None else own.unionByName(_expanded(logs[k + 1], above, levels)), "merkle-paths")
    return above


def proofs(manifest: Manifest) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, path (siblings up to the
    root, packed), proof_sha256, folded_root (of the claim where there is one)
    and verified. Rows are joined a block at a time."""
    none, empty, levels = F.lit(None), F.lit(b""), manifest.levels
    top = manifest.sources[-1].filter("whole").select(
        "tree", "block", none.cast("string").alias("name"), none.cast("binary").alias("subroot"), empty.alias("path"), F.col("top").alias("root"))
    of_sources = _expanded(manifest.sources[0], _paths(manifest.sources, top, levels), levels)
    above = _paths(manifest.documents, of_sources.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"),
                                                         none.cast("string").alias("name"), "subroot", "path", "root"), levels)
    schema = ("doc_id string, leaf binary, subroot binary, root binary, path binary, proof_sha256 string, "
              "folded_root binary, verified boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                upper, nodes, tops, out = unpacked(row["path"]), _cut(row["nodes"]), {}, []
                upper_hex = "".join(d.hex() for left, right in upper for d in (*left, *right))
                for i, path in enumerate(_block_paths(row, levels)):
                    leaf = nodes[postorder(0, i, row["n"])]
                    mid = fold(leaf if row["claims"][i] is None else row["claims"][i], path)
                    if mid not in tops:
                        tops[mid] = fold(mid, upper)
                    near = "".join(d.hex() for left, right in path for d in (*left, *right))
                    out.append({"doc_id": row["names"][i], "leaf": leaf, "subroot": row["subroot"], "root": row["root"],
                                "path": _packed(path) + row["path"],
                                "proof_sha256": hashlib.sha256((near + upper_hex).encode()).hexdigest(),
                                "folded_root": tops[mid], "verified": tops[mid] == row["root"]})
                yield _batch(out, schema)

    found = manifest.documents[0].join(above.select("tree", "block", "subroot", "path", "root"), ["tree", "block"])
    return found.mapInArrow(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def proof_of(manifest: Manifest, source: str | None, doc_id: int) -> list[tuple[list[bytes], list[bytes]]]:
    """Random access: the path of one document, read from one block a tier."""
    tree, path, index, size = "-" if source is None else "=" + source, [], None, ARITY ** manifest.levels
    for logs, name in ((manifest.documents, str(doc_id)), (manifest.sources, tree)):
        at = F.array_contains("names", name)
        for log in logs:
            row = log.filter((F.col("tree") == tree) & at).first()
            if row is None:
                raise KeyError((source, doc_id))
            index = row["names"].index(name) if name is not None else index % size
            path += list(_block_paths(row.asDict(), manifest.levels))[index]
            if row["whole"]:
                break
            index, name = row["block"], None
            at = F.col("block") == index // size
        tree = ""
    return path


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every document's proof; where 2 divides crc32(doc_id), the proof
    of the text without its line feeds is tried instead."""
    from .common import table

    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0,
                      F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = proofs(build(leaves(table(spark, sf_dir, "documents"), tampered)))
    text = lambda name: F.lower(F.hex(name)).alias(name)
    return found.select("doc_id", text("leaf"), text("subroot"), text("root"), "proof_sha256", text("folded_root"), "verified")
