"""SimHash near-de-duplication with vantage-point trees.

Fingerprints (64 bits over word shingles) are partitioned by their Hamming distance to vantage points, by the
triangle inequality: two fingerprints whose distances to a vantage point differ by d are at least d apart, and
inside disjoint blocks of bits such bounds add up.

The bits are cut into one block more than the link distance, so two linked fingerprints agree in one block at
least, and are then equally far from every vantage point inside it. Each block has a tree of its own, cut at
the medians of a bounded sample; a fingerprint goes down each tree without crossing a cut, which makes exactly
as many copies as there are blocks, whatever the number of documents. The leaves are the shards. Inside a shard
further vantage points of the block part the fingerprints into cells of equal distances. The fingerprints of a
small cell are compared exactly; a cell that stays large is parted by levels over all bits, where a fingerprint
visits the other side of a cut as long as its ways to the cuts sum to at most the link distance, else the branch
is pruned (blocks of a family of levels are disjoint; a new family starts a new sum). A shard reports a star per
local group and not its pairs, so dense groups cost rows in proportion to their members; a pair found in several
trees is linked in each. Links are contracted by ``graph.components``. No pair within the distance is lost.

Defined results: null and empty texts have fingerprint zero and are linked like any other; texts with
fewer words than a shingle are one shingle; repeated rows and ties keep one row each; a null id never
counts as the smallest unless the whole component has none (then component_id is null).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import fresh, tidy, with_row_id, written
from ingestkit.llm.graph import components

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
SHARD_SIZE = 16_384
LEAF_SIZE = 256
#: Most fingerprints of the sample that the shard cuts are taken from.
SAMPLE_MAX = 65_536
CHUNK = 1 << 16

BLOCK_BITS = 8
LEVELS = 64 // BLOCK_BITS
FAMILIES = 4


def _masks() -> list[np.uint64]:
    """Per level the bits of its block; a family orders the bits by steps of an odd number."""
    out = []
    for step in range(1, 2 * FAMILIES, 2):
        for i in range(LEVELS):
            block = range(i * BLOCK_BITS, (i + 1) * BLOCK_BITS)
            out.append(np.uint64(sum(1 << (b * step * 5**(step // 2) % 64) for b in block)))
    return out


MASKS = _masks()


def blocks(bits: int) -> list[np.uint64]:
    """Masks of ``bits + 1`` disjoint blocks of about equal size."""
    if not 0 <= bits < 64:
        raise ValueError("the link distance must be from 0 to 63")
    n = bits + 1
    ends = [64 * i // n for i in range(n + 1)]
    return [np.uint64((1 << ends[i + 1]) - (1 << ends[i])) for i in range(n)]


def fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """Bit b is set when more than half of the shingles' hashes have it; zero without a word."""
    w = (text or b"").lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(w))
    starts, ends = starts[: len(w) - k + 1], ends[k - 1 :]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        pairs = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        h = np.array([digest(joined[a:b], HASH_SEED) for a, b in pairs], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_id: str | None = None,
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(row_id, doc_id, fp) per row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], ["row_id", "doc_id", "fp"])

    body = docs.select(
        (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("row_id"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").cast("binary").alias("body"),
    )
    return body.mapInArrow(tidy(run), "row_id long, doc_id long, fp long")


@dataclass
class Node:
    vantage: np.uint64
    cut: int
    low: Node | int
    high: Node | int


def _distance(x: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((x ^ vantage) & mask).astype(np.int16)


def build(sample: np.ndarray, mask: np.uint64, depth: int) -> Node | int:
    """Shard tree of one block, ``depth`` levels cut at the sample's medians; leaves are numbered from 0."""
    number = iter(range(1 << depth))

    def grow(part: np.ndarray, level: int) -> Node | int:
        if level == depth:
            return next(number)
        vantage, cut, size = np.uint64(0), 0, int(np.bitwise_count(mask))
        if len(part):
            vantage = part[level % len(part)]
            d = _distance(part, vantage, mask)
            cut = min(range(size), key=lambda c: abs((d <= c).mean() - 0.5))
        low = _distance(part, vantage, mask) <= cut
        return Node(vantage, cut, grow(part[low], level + 1), grow(part[~low], level + 1))

    return grow(sample, 0)


def route(tree: Node | int, x: np.ndarray, mask: np.uint64) -> np.ndarray:
    """Shard of every fingerprint of ``x`` in the tree of one block: a function of the block's bits only."""
    out = np.zeros(len(x), np.int32)
    stack = [(tree, np.arange(len(x)))]
    while stack:
        node, rows = stack.pop()
        if isinstance(node, int):
            out[rows] = node
        elif len(rows):
            low = _distance(x[rows], node.vantage, mask) <= node.cut
            stack += [(node.low, rows[low]), (node.high, rows[~low])]
    return out


def cells(x: np.ndarray, mask: np.uint64, small: int) -> list[np.ndarray]:
    """Rows of ``x`` by equal distances, inside the block, to vantage points of their own; cells of more than
    ``small`` rows are parted on until their rows agree in the block."""
    done, stack = [], [np.arange(len(x))]
    while stack:
        rows = stack.pop()
        if len(rows) <= small:
            done.append(rows)
            continue
        other = (x[rows] ^ x[rows[0]]) & mask
        at = int(np.bitwise_count(other).argmax())
        if not other[at]:
            done.append(rows)
            continue
        d = _distance(x[rows], x[rows[0]], mask) * np.int16(64) + _distance(x[rows], x[rows[at]], mask)
        order = np.argsort(d, kind="stable")
        parts = np.split(rows[order], np.flatnonzero(np.diff(d[order])) + 1)
        if len(parts) == 1:  # unequal rows at equal distances: part by one bit that differs from the first row's
            bit = other[at] & -other[at]
            has = (x[rows] & bit) != 0
            parts = [rows[has], rows[~has]]
        stack += parts
    return done


def _part(d: np.ndarray, cut: int, budget: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, ...]:
    """Who goes low and high, with the way to the other side: members of the high side do not visit
    the low one (a pair is found from its low side), visitors look at both."""
    low = d <= cut
    way = np.where(low, cut + 1 - d, d - cut)
    over = (way <= budget) & (low | ~home)
    return low, way, over


class Groups:
    """Disjoint sets over 0..n-1 with array operations; a root is the least member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.parent[x]
        while (nxt := self.parent[r]).tobytes() != r.tobytes():
            r = nxt
        return r

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            self.parent[np.maximum(ra, rb)] = np.minimum(ra, rb)


def search(x: np.ndarray, bits: int, groups: Groups, rows: np.ndarray) -> None:
    """Links all of ``rows`` that are within ``bits`` of each other in ``groups``."""

    def compare(mem: np.ndarray, vis: np.ndarray) -> None:
        every = np.concatenate((mem, vis))
        for at in range(0, len(every), 512):
            q = every[at : at + 512]
            for to in range(0, len(mem), 4096):
                m = mem[to : to + 4096]
                i, j = np.nonzero(np.bitwise_count(x[q][:, None] ^ x[m][None, :]) <= bits)
                groups.link(q[i], m[j])

    none = np.zeros(0, np.int16)
    stack = [(rows, rows[:0], none, np.full(len(rows), bits, np.int16), 0)]
    while stack:
        mem, vis, vis_budget, mem_budget, level = stack.pop()
        if not len(mem) or len(mem) + len(vis) < 2:
            continue
        if len(mem) <= LEAF_SIZE or level >= len(MASKS):
            compare(mem, vis)
            continue
        if level % LEVELS == 0:
            vis_budget, mem_budget = np.full(len(vis), bits, np.int16), np.full(len(mem), bits, np.int16)
        vantage, mask = x[mem[0]], MASKS[level]
        d = _distance(x[mem], vantage, mask)
        cut = int(np.median(d))
        if (d <= cut).all():
            cut -= 1
        if cut < 0:
            stack.append((mem, vis, vis_budget, mem_budget, level + 1))
            continue
        low, way, over = _part(d, cut, mem_budget, np.ones(len(mem), bool))
        vlow, vway, vover = _part(_distance(x[vis], vantage, mask), cut, vis_budget, np.zeros(len(vis), bool))
        for here, vhere, cross in ((low, vlow, np.zeros(len(mem), bool)), (~low, ~vlow, low & over)):
            visit = vover & ~vhere
            stack.append((
                mem[here],
                np.concatenate((vis[vhere], vis[visit], mem[cross])),
                np.concatenate((vis_budget[vhere], vis_budget[visit] - vway[visit], mem_budget[cross] - way[cross])),
                mem_budget[here],
                level + 1,
            ))


def shard_roots(x: np.ndarray, mask: np.uint64, bits: int) -> np.ndarray:
    """Roots of the local groups of a shard of one block: links between fingerprints that agree in the block."""
    groups = Groups(len(x))
    for rows in cells(x, mask, LEAF_SIZE):
        search(x, bits, groups, rows)
    return groups.roots(np.arange(len(x)))


def links(fps: DataFrame, bits: int = MAX_BITS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``fp`` within ``bits`` of each other."""
    n, masks = fps.count(), blocks(bits)
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / shard_size))))
    depth = min(depth, int(min(np.bitwise_count(masks))))
    size = min(SAMPLE_MAX, 64 << depth)
    sample = fps.orderBy(F.xxhash64("fp"), "fp").limit(size).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    trees = [build(sample, m, depth) for m in masks]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i, (tree, mask) in enumerate(zip(trees, masks, strict=True)):
                shard = (i << depth) + route(tree, x, mask)
                yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), b.column(0)], ["shard", "fp"])

    def shard_links(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        root = shard_roots(x, masks[int(pdf["shard"].iloc[0]) >> depth], bits)
        linked = np.nonzero(root != np.arange(len(x)))[0]
        return pd.DataFrame({"a": x[linked].view(np.int64), "b": x[root[linked]].view(np.int64)})

    placed = fps.select("fp").mapInArrow(tidy(place), "shard int, fp long")
    return placed.groupBy("shard").applyInPandas(shard_links, "a long, b long")


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS, shingle: int = SHINGLE_WORDS, **kw) -> DataFrame:
    """row_id, doc_id, fingerprint (hex), component_id and kept (the first row of each component)."""
    rows = written(fingerprints(docs, shingle=shingle, **kw), "fingerprints")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")).alias("head")
    fps = written(rows.groupBy("fp").agg(head), "distinct")
    comps = written(components(links(fps, bits)), "components")
    named = written(
        fps.join(comps, fps["fp"] == comps["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "head"),
        "named",
    )
    heads = named.groupBy("root").agg(F.min("head").alias("head"))
    final = written(named.select("fp", "root").join(heads, "root").select("fp", "head"), "heads")
    return rows.join(final, "fp").select(
        "row_id",
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head.doc_id").alias("component_id"),
        (F.col("row_id") == F.col("head.row_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, bits: int = MAX_BITS, shingle: int = SHINGLE_WORDS,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the smallest id of each component only, all columns unchanged."""
    rid = fresh(docs, "row_id")
    stamped = written(with_row_id(docs, rid), "stamped")
    found = near_duplicates(stamped, bits, shingle, id_col=id_col, text_col=text_col, row_id=rid)
    dropped = written(found.where(~F.col("kept")).select(F.col("row_id").alias(rid)), "dropped")
    return stamped.join(dropped, rid, "left_anti").drop(rid)
