"""Substring de-duplication by seed and extend.

Every window of ``length`` words holds ``length - gram + 1`` word n-grams; the one with the least hash is
its anchor (winnowing), so equal windows have the same anchor at the same place. Documents are joined on
their anchors: an anchor of one document only is done with, one of several documents is a seed.

A seed is extended both ways as far as the windows that chose it reach. Occurrences whose whole extended
context is equal are settled at once: all but the smallest document's are repeats. Where contexts of a
seed differ, the extension goes word by word: the windows of one representative of each context are
grouped, and each gets the smallest document that has it. Runs of covered windows make the maximal
repeats, which are removed.

Groups are never expanded into pairs: seeds, contexts and windows are reduced to their smallest document
before and after the shuffle, and the joins run between written tables, so a passage that a third of all
documents share is split by adaptive execution. Only documents that need a second look (representatives
of open contexts, and documents with repeats) do work again; their words travel compressed.

Windows are compared by 64-bit hashes within one seed (itself a 64-bit hash). Defined results: null and
empty texts have no words; a document without id counts as larger than any other and repeated rows of an
id are judged alike (a window is only taken from the larger id); further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import tidy, written

LENGTH = 50
GRAM = 8

#: Tuning values: rows that a task works on at once, and window rows that it hands over at once.
SLICE_ROWS = 512
WINDOW_ROWS = 1 << 15

#: An odd base of the polynomial word hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
NO_ID = (1 << 63) - 1


class Rolling:
    """Hashes of word spans from prefix sums of a polynomial modulo 2**64."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, words: list[bytes]):
        n = len(words)
        if len(Rolling._powers) < n:
            Rolling._powers = _powers_of(BASE, 2 * n)
            Rolling._inverses = _powers_of(INVERSE, 2 * n)
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(w) for w in words), np.uint64, n)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * Rolling._powers[:n])))

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        h = (self.sums[stop] - self.sums[start]) * Rolling._inverses[start]
        return _mixed(h + (stop - start).astype(np.uint64))


def _powers_of(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def anchors(roll: Rolling, n: int, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(seed hash, context hash, first window, windows) of each anchor of a document of ``n`` words."""
    if n < length:
        e = np.zeros(0, np.int64)
        return e, e, e, e
    at = np.arange(n - gram + 1)
    grams = roll.spans(at, at + gram)
    view = np.lib.stride_tricks.sliding_window_view(grams, length - gram + 1)
    place = view.argmin(axis=1) + np.arange(len(view))
    first = np.nonzero(np.diff(place, prepend=-1))[0]
    last = np.append(first[1:], len(place)) - 1
    seed = place[first]
    context = roll.spans(first, last + length) ^ _mixed((seed - first).astype(np.uint64))
    return grams[seed].view(np.int64), context.view(np.int64), first, last - first + 1


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows that agree in (did, th) have equal ids and texts and get equal results."""
    body = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("did"),
        F.xxhash64(body).alias("th"),
        body.cast("binary").alias("body"),
    )


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most SLICE_ROWS rows: what a task makes of a batch before Spark takes it is bounded by that."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(at, SLICE_ROWS)


def _packed(keyed: DataFrame) -> DataFrame:
    """(did, th, blob): the words, compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for b in _sliced(batches):
            blobs = [pack.compress(b" ".join((t.as_py() or b"").split())) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(blobs, pa.binary())], ["did", "th", "blob"])

    return keyed.select("did", "th", "body").mapInArrow(tidy(run), "did long, th long, blob binary")


def _unpacked(blob: bytes) -> list[bytes]:
    return zstandard.decompress(blob).split()


def scan(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """Per row: its ids, word count, hash of its words and the anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        for b in _sliced(batches):
            n_words, digests, parts = [], [], ([], [], [], [])
            for t in b.column(3):
                w = (t.as_py() or b"").split()
                n_words.append(len(w))
                digests.append(hashlib.sha256(b" ".join(w)).hexdigest())
                for to, x in zip(parts, anchors(Rolling(w), len(w), length, gram), strict=True):
                    to.append(x)
            cols = [pa.array(p, k) for p, k in zip(parts, (longs, longs, ints, ints), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(n_words, pa.int64()), pa.array(digests), *cols],
                ["doc_id", "did", "th", "n_words", "sha", "seed", "context", "first", "n"],
            )

    return keyed.mapInArrow(
        tidy(run),
        "doc_id long, did long, th long, n_words long, sha string, "
        "seed array<long>, context array<long>, first array<int>, n array<int>",
    )


def _batches(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)
    for at in range(0, whole.num_rows, WINDOW_ROWS):  # the windows of one long document are many
        yield whole.slice(at, WINDOW_ROWS)


def _windows(joined: DataFrame, length: int) -> DataFrame:
    """One row per window of the asked contexts: (seed, context, t, window, did)."""

    names = ["seed", "context", "t", "window", "did"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for b in batches:
            for did, blob, asked in zip(b.column(0), b.column(1), b.column(2), strict=True):
                roll = Rolling(_unpacked(blob.as_py()))
                f = [asked.values.field(k).to_numpy(zero_copy_only=False) for k in range(4)]
                n = f[3].astype(np.int64)
                t = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(f[2].astype(np.int64), n) + t
                window = roll.spans(start, start + length).view(np.int64)
                parts.append((np.repeat(f[0], n), np.repeat(f[1], n), t.astype(np.int32), window, np.full(len(t), did.as_py(), np.int64)))
                rows += len(t)
                if rows >= WINDOW_ROWS:  # a batch per document would cost Spark more than its rows
                    yield from _batches(parts, names)
                    parts, rows = [], 0
        if parts:
            yield from _batches(parts, names)

    return joined.select("did", "blob", "asked").mapInArrow(tidy(run), "seed long, context long, t int, window long, did long")


def _cut(joined: DataFrame, length: int) -> DataFrame:
    """(did, th, n_removed, kept) with the words outside the covered runs of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            removed, kept = [], []
            for blob, runs in zip(b.column(2), b.column(3), strict=True):
                w = _unpacked(blob.as_py())
                a, z = (runs.values.field(k).to_numpy(zero_copy_only=False) for k in range(2))
                edge = np.zeros(len(w) + 1, np.int64)
                np.add.at(edge, a, 1)
                np.add.at(edge, z + length, -1)
                covered = np.cumsum(edge[:-1]) > 0
                removed.append(int(covered.sum()))
                kept.append(b" ".join([x for x, c in zip(w, covered.tolist(), strict=True) if not c]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["did", "th", "n_removed", "kept"],
            )

    return joined.select("did", "th", "blob", "runs").mapInArrow(tidy(run), "did long, th long, n_removed long, kept binary")


def covered_runs(keyed: DataFrame, scanned: DataFrame, length: int) -> DataFrame:
    """(did, th, runs): per document the runs (first, last) of windows that a smaller document has too."""
    occ = scanned.select("did", "th", F.explode(F.arrays_zip("seed", "context", "first", "n")).alias("o")).select(
        "did", "th", "o.*"
    )
    shared = (
        occ.groupBy("seed")
        .agg(F.min("did").alias("low"), F.max("did").alias("high"), F.min("context").alias("c0"), F.max("context").alias("c1"))
        .where("low < high")
        .select("seed", "low", (F.col("c0") == F.col("c1")).alias("settled"))
    )
    shared = written(shared, "seeds")
    hits = written(occ.join(shared, "seed"), "hits")
    settled = hits.where("settled and low < did").select(
        "did", "th", F.array(F.struct(F.col("first").alias("a"), (F.col("first") + F.col("n") - 1).alias("z"))).alias("runs")
    )
    unsettled = hits.where("not settled")
    reps = unsettled.groupBy("seed", "context").agg(F.min(F.struct("did", "th", "first", "n")).alias("r"))
    asked = written(
        reps.groupBy("r.did", "r.th").agg(F.collect_list(F.struct("seed", "context", "r.first", "r.n")).alias("asked")),
        "asked",
    )
    win = written(_windows(_packed(keyed).join(asked, ["did", "th"]), length), "windows")
    least = win.groupBy("seed", "window").agg(F.min("did").alias("m"), F.count(F.lit(1)).alias("k")).where("k > 1")
    least = written(least, "least")
    mins = written(
        win.join(least, ["seed", "window"]).groupBy("seed", "context").agg(F.collect_set(F.struct("t", "m")).alias("mins")),
        "extended",
    )
    # a context's representative is its smallest document: its own windows count for the others
    own = unsettled.groupBy("seed", "context").agg(F.min("did").alias("own"))
    mins = written(own.join(mins, ["seed", "context"], "left"), "contexts")
    opened = unsettled.where("low < did").join(mins, ["seed", "context"]).select(
        "did", "th",
        F.when(F.col("own") < F.col("did"),
               F.array(F.struct(F.col("first").alias("a"), (F.col("first") + F.col("n") - 1).alias("z"))))
        .otherwise(F.transform(
            F.filter(F.coalesce("mins", F.array().cast("array<struct<t:int,m:bigint>>")), lambda x: x["m"] < F.col("did")),
            lambda x: F.struct((F.col("first") + x["t"]).alias("a"), (F.col("first") + x["t"]).alias("z")),
        )).alias("runs"),
    )
    runs = settled.unionByName(opened).where(F.size("runs") > 0)
    return runs.groupBy("did", "th").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, as UTF-8 text; null where nothing was removed)
    and kept_sha256, one row per input row."""
    keyed = _keyed(docs, id_col, text_col)
    scanned = written(scan(keyed, length, gram), "anchors")
    runs = written(covered_runs(keyed, scanned, length), "runs")
    cut = _cut(_packed(keyed).join(runs, ["did", "th"]), length).dropDuplicates(["did", "th"])
    cut = written(cut.withColumn("kept_sha", F.sha2("kept", 256)), "cut")
    return scanned.select("doc_id", "did", "th", "n_words", "sha").join(cut, ["did", "th"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.col("kept").cast("string").alias("kept"), F.coalesce("kept_sha", "sha").alias("kept_sha256"),
    )


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, {NO_ID}) AS did,
  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT rid, did, i, md5(array_to_string(w[i:i + {LENGTH - 1}], ' ')) AS h
  FROM (SELECT rid, did, w, unnest(range(1, len(w) - {LENGTH - 2})) AS i FROM d)),
cov AS (SELECT DISTINCT rid, i + unnest(range({LENGTH})) AS p FROM
  (SELECT rid, i, did, min(did) OVER (PARTITION BY h) AS m FROM win) WHERE m < did),
gone AS (SELECT rid, list(p) AS ps, count(*) AS n FROM cov GROUP BY rid),
word AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM d SEMI JOIN gone USING (rid)),
kept AS (SELECT rid, string_agg(w[p], ' ' ORDER BY p) AS s FROM word ANTI JOIN cov USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(gone.n, 0) AS n_removed,
  sha256(CASE WHEN gone.n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept.s, '') END) AS kept_sha256
FROM d LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)"""
