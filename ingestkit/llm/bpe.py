"""Byte-level BPE encoding and decoding.

Texts are split by the tokenizer's pattern. Words are encoded by a fold of Spark higher-order functions
over the word's bytes: the state is the array of pieces, each with its id and its rank with the next; each
step merges the leftmost pair of least rank. Ranks come from a map of constant arrays: one of all pairs of
bytes, and one of all pairs of pieces, the rows of the left pieces laid over each other, so that one addition
names the only place where a pair can be. The map is a table of one row, read by a scalar subquery: as literals
it would stand in the text of every plan, which the driver keeps.

Distinct words are encoded once: the words of the whole corpus are counted, the most frequent ones (at
most ``FREQUENT``, whole classes of equal magnitude) are encoded and sent to every task, a table of
bounded size; any other word is encoded by the same fold inside its document, once per document. No
text and no word occurrence is shuffled except the counts. Words over ``LONG`` bytes, for which the fold
would take quadratic time, are merged with a heap instead. Decoding concatenates the pieces' bytes.

Ids are little-endian unsigned 32-bit integers in a binary column. Defined results: null and empty texts
have no ids; nothing depends on ids, order or repetition of rows; further columns are ignored. Letters
and numbers are those of the running Java's Unicode version.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import fresh, relieve, tidy, written

FREQUENT = 1 << 19
PLACE_BITS = 6
LONG = 1 << PLACE_BITS
ID_BITS = 16
#: The rank of two pieces that do not merge: above all ranks.
NONE = 1 << 16
#: Places looked at together, times the length of a row, when rows are laid over each other; rows up to ``SHORT``
#: look for gaps from the start again.
PLACES = 1 << 16
SHORT = 16
#: Documents put together at a time when ids are laid out.
GROUP = 256
BATCH_BYTES = 2 << 20


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
        if rank == 1 << 30:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def _laid_over(rows: dict[int, list[int]]) -> list[int]:
    """A start for each number, so that no two places ``start + right`` of the rows are the same; the longest
    rows are laid first, the shorter ones into their gaps."""
    width = 1 + max((max(row) for row in rows.values()), default=0)
    free = np.ones(width, bool)
    starts, at, gaps_from = [0] * (1 + max(rows, default=-1)), 0, SHORT.bit_length() + 1
    for left in sorted(rows, key=lambda i: (-len(rows[i]), i)):
        row = np.array(sorted(rows[left]), np.int64)
        if len(row).bit_length() < gaps_from:
            at, gaps_from = 0, len(row).bit_length()
        step = PLACES // len(row) + 1
        while True:
            if at + step + width > len(free):
                free = np.concatenate((free, np.ones(width + step, bool)))
            first = at + np.flatnonzero(free[at : at + step])
            fits = free[first[:, None] + (row - row[0])].all(axis=1)
            if fits.any():
                break
            at += step
        at = int(first[fits.argmax()])
        free[at + (row - row[0])] = False
        starts[left] = at - int(row[0])
    return starts


@lru_cache(maxsize=4)
def _literal(path: str) -> tuple[str, str, str, str, tuple[str, ...]]:
    """The rank map as comma-separated numbers: starts of the left pieces, cells, byte ids, ranks of two
    bytes; and the pieces (hex) that merging their bytes does not produce, which a tokenizer takes as a
    whole all the same.

    The cell at the start of a left piece plus the id of a right one holds ``left id * 2**16 + rank`` if
    the two merge; else it is empty (-1), of another left piece, or beyond the ends.
    """
    ranks = read_ranks(path)
    if max(ranks.values(), default=0) >= (1 << 16) - 1:
        raise ValueError("ids over 16 bits")
    rows: dict[int, dict[int, int]] = defaultdict(dict)
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                rows[left][right] = rank
    starts = _laid_over({left: list(row) for left, row in rows.items()})
    full = {starts[left] + right: (left << ID_BITS) + rank for left, row in rows.items() for right, rank in row.items()}
    cells = [full.get(i, -1) for i in range(1 + max(full, default=-1))]
    whole = tuple(p.hex().upper() for p in ranks if len(_merged(p, ranks)) > 1)
    single = [ranks[bytes([i])] for i in range(256)]
    pairs = [ranks.get(bytes([i, j]), NONE) for i in range(256) for j in range(256)]
    return *(",".join(map(str, x)) for x in (starts, cells, single, pairs)), whole


@lru_cache(maxsize=4)
def _rank_map(path: str) -> pa.Table:
    """The rank map as one row of arrays."""
    rows = ([[int(x) for x in n.split(",") if x]] for n in _literal(path)[:4])
    return pa.table([pa.array(x, pa.list_(pa.int64())) for x in rows], ["starts", "cells", "ids", "pairs"])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, as ``common.let`` but without an array for it."""
    return F.aggregate(F.array(), value, lambda v, _: v, body)


class Fold:
    """Expressions over the rank map of one rank file.

    The map stands once in an expression and is bound to the variable ``t``; every lookup refers to it.

    The state of a fold is one array of longs, one for each piece, left to right: the rank of the piece
    with its right neighbour (``NONE`` if they do not merge), the place of its first byte and its id, in
    this order of bits. No two are equal, and the least of them names the leftmost pair of least rank.
    """

    def __init__(self, path: str):
        self.whole, self.ranks = _literal(path)[-1], _rank_map(path)

    @property
    def literal(self) -> Column:
        """The map as literals, for plans that are not kept."""
        arrays = {name: self.ranks[name][0].values for name in self.ranks.column_names}
        texts = ((name, ",".join(map(str, x.to_pylist()))) for name, x in arrays.items())
        return F.struct(*(F.split(F.lit(n), ",", -1).cast("array<bigint>").alias(name) for name, n in texts))

    @staticmethod
    def _rank(t: Column, left: Column, right: Column) -> Column:
        """Rank (which is the id) of two neighbouring ids as one piece, or ``NONE``; null is no neighbour."""
        cell = F.get(t["cells"], (F.get(t["starts"], left.cast("int")) + right).cast("int"))
        return let(cell, lambda v: F.when(F.shiftright(v, ID_BITS) == left, v.bitwiseAND((1 << ID_BITS) - 1)).otherwise(F.lit(NONE)))

    def _encode(self, t: Column, word: Column) -> Column:
        id_mask, rank_bits = (1 << ID_BITS) - 1, ID_BITS + PLACE_BITS
        place_mask = (1 << rank_bits) - 1 - id_mask

        def merged(s: Column, m: Column, i: Column) -> Column:
            """``m``: the left of the two pieces, ``i``: the index of the right one."""

            def put(new: Column) -> Column:
                after, before = F.get(s, i + 1).bitwiseAND(id_mask), F.get(s, i - 2)
                own = F.shiftleft(self._rank(t, new, after), rank_bits) + m.bitwiseAND(place_mask) + new
                left = F.shiftleft(self._rank(t, before.bitwiseAND(id_mask), new), rank_bits) + before.bitwiseAND(place_mask + id_mask)
                pieces = F.struct(own.alias("own"), left.alias("left"), (i - 2).alias("before"))
                return let(pieces, lambda p: F.array_compact(F.transform(s, lambda x, j: F.when(j < p["before"], x).when(j > i, x)
                           .when(j == i, F.lit(None)).when(j == p["before"], p["left"]).otherwise(p["own"]))))

            return let(F.shiftright(m, rank_bits), put)

        def step(s: Column, _: Column) -> Column:
            return let(F.array_min(s), lambda m: F.when(m >= NONE << rank_bits, s).otherwise(
                let(F.array_position(s, m).cast("int"), lambda i: merged(s, m, i))))

        def fold(codes: Column) -> Column:
            """``codes``: the bytes as numbers."""
            def first(c: Column, i: Column) -> Column:
                rank = F.coalesce(F.get(t["pairs"], c * 256 + F.get(codes, i + 1)), F.lit(NONE))
                return F.shiftleft(rank, rank_bits) + F.shiftleft(i.cast("long"), ID_BITS) + F.get(t["ids"], c)

            end = F.aggregate(F.slice(codes, 2, LONG), F.transform(codes, first), step)  # one step for each gap
            return F.transform(end, lambda x: x.bitwiseAND(id_mask).cast("int"))

        def codes(chars: Column) -> Column:
            return F.transform(F.sequence(F.lit(1), F.char_length(chars)), lambda i: F.ascii(F.substr(chars, i, F.lit(1))))

        body = word.cast("binary")
        taken = F.octet_length(word) <= LONG
        if self.whole:
            taken = taken & ~F.hex(body).isin(*self.whole)
        # a byte is the character of its number
        return F.when(taken, let(F.decode(body, "ISO-8859-1"), lambda chars: let(codes(chars), fold)))

    def encode(self, words: Column, ranks: Column | None = None) -> Column:
        """Ids (array<int>) of each word of an array; null for a word that ``merge_long`` is to take. ``ranks``: the map."""
        ranks = self.literal if ranks is None else ranks
        return let(ranks, lambda t: F.transform(words, lambda w: self._encode(t, w)))

    def encoded(self, df: DataFrame, words: Column, name: str) -> DataFrame:
        """``df`` with the ids of ``words`` as ``name``. The map is a scalar subquery of one row; used once, the optimizer
        puts it in the place of the column that names it, so that no row carries it."""
        ranks = fresh(df, "rank_map")
        row = df.sparkSession.createDataFrame(self.ranks).select(F.struct("*"))
        return df.withColumn(ranks, row.scalar()).select(*df.columns, self.encode(words, F.col(ranks)).alias(name))


def split_words(text: Column, pattern: str) -> Column:
    """All matches of the pattern; ``\\s`` is Unicode white space."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(f"(?U){pattern}"), F.lit(0))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges by a heap of neighbour ranks, for words too long for the fold."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, nxt, prv = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    live = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = nxt[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i] if live[i] else n
        if j >= n or end[j] != stop:
            continue  # one of the two has been merged meanwhile
        end[i], nxt[i], live[j] = stop, nxt[j], False
        if nxt[i] < n:
            prv[nxt[i]] = i
        offer(i)
        if prv[i] >= 0:
            offer(prv[i])
    return [ranks[word[i : end[i]]] for i in range(n) if live[i]]


def frequent_words(docs: DataFrame, fold: Fold, pattern: str, text_col: str, most: int = FREQUENT) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The most frequent words of the corpus, where the ids of each end (after a 0), and the ids (16 bits)."""
    words = docs.select(F.explode(split_words(F.col(text_col), pattern)).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = written(counts.withColumn("class", F.floor(F.log2("n") * 64).cast("int")), "words")
    floor, total = 1 << 30, 0
    for r in counts.groupBy("class").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("class")).collect():  # < 64 * 64 classes
        total += r["k"]
        if total > most:
            break
        floor = r["class"]
    top = counts.where((F.col("class") >= floor) & (F.octet_length("word") <= LONG))
    got = fold.encoded(top.select("word"), F.array("word"), "ids").select("word", F.get("ids", F.lit(0)).alias("ids")).toArrow()  # at most ``most``
    got = got.filter(pc.is_valid(got["ids"]))  # here, as a filter in Spark would encode every word twice
    ids = got["ids"].combine_chunks()
    return got["word"].combine_chunks(), ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype(np.uint16)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values cut from one array of 32-bit numbers at ``ends``, without a copy of each."""
    offsets = pa.py_buffer((ends * 4).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def _hashes(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words.to_pylist()], np.uint64)


def _marked(docs: DataFrame, pattern: str, text_col: str, words: pa.Array) -> DataFrame:
    """``docs`` with ``known`` (per word its place among the frequent words, or -1 - its place in
    ``rare``) and ``rare`` (the document's other words, each once)."""

    hashes, place = np.unique(_hashes(words), return_index=True)  # of words with one hash all but the first count as rare
    shared = docs.sparkSession.sparkContext.broadcast((hashes, place.astype(np.int32), words))

    def found(names: pa.Array) -> np.ndarray:
        """Place of each name among ``words``, or -1."""
        hashes, place, words = shared.value
        if not len(hashes):
            return np.full(len(names), -1, np.int32)
        h = _hashes(names)
        near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        same = (hashes[near] == h) & pc.equal(words.take(pa.array(place[near])), names).to_numpy(zero_copy_only=False)
        return np.where(same, place[near], -1).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(1)
            coded, sizes = col.flatten().dictionary_encode(), np.diff(col.offsets.to_numpy())
            names, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            at = found(names)[code] if len(names) else np.zeros(0, np.int32)
            doc = np.repeat(np.arange(b.num_rows), sizes)
            other = np.nonzero(at < 0)[0]
            code = code[other]
            pair, inverse = np.unique(doc[other] * (len(names) + 1) + code, return_inverse=True)
            pair_doc = pair // (len(names) + 1)
            first = np.searchsorted(pair_doc, np.arange(b.num_rows + 1))
            at[other] = -1 - (inverse - first[doc[other]])
            rare = pa.ListArray.from_arrays(pa.array(first, pa.int32()), names.take(pa.array(pair % (len(names) + 1))))
            known = _binary(at.astype("<i4"), np.concatenate(([0], np.cumsum(sizes))))
            yield pa.RecordBatch.from_arrays([b.column(0), known, rare], ["row", "known", "rare"])

    kept = [c for c in docs.columns if c != text_col] or [F.lit(None).cast("int").alias("none")]
    split = docs.select(F.struct(*kept).alias("row"), split_words(F.col(text_col), pattern).alias("words"))
    row = split.schema["row"].dataType.simpleString()
    return split.mapInArrow(tidy(run), f"row {row}, known binary, rare array<string>")


def _laid_out(marked: DataFrame, starts: np.ndarray, pool: np.ndarray, ranks: dict[bytes, int]) -> DataFrame:
    """(row, n_tokens, ids) from the places of the words and the ids of the rare ones."""

    shared = marked.sparkSession.sparkContext.broadcast((starts, pool, pa.array([*ranks], pa.binary()), np.array([*ranks.values()], np.uint16)))
    long_words: dict[bytes, int] = {}  # the ranks, in tasks that meet a long word

    def laid(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of ``b`` one after the other, and where each ends."""
        starts, pool, pieces, numbers = shared.value
        at = np.concatenate([np.frombuffer(x.as_py(), "<i4") for x in b.column(1)] or [np.zeros(0, "<i4")])
        words_in = np.array([len(x) // 4 for x in (y.as_buffer() for y in b.column(1))], np.int64)
        lists, words = b.column(3).flatten(), b.column(2).flatten()
        own_pool = lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint32)
        own_size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        own_start = np.cumsum(own_size) - own_size
        for i in np.flatnonzero(lists.is_null().to_numpy(zero_copy_only=False)) if lists.null_count else ():
            if not long_words:
                long_words.update(zip(pieces.to_pylist(), numbers.tolist(), strict=True))
            ids = merge_long(words[int(i)].as_py().encode(), long_words)
            own_start[i], own_size[i] = len(own_pool), len(ids)
            own_pool = np.append(own_pool, np.array(ids, np.uint32))
        rare = at < 0
        # a document's rare words follow those of the documents before it
        in_doc = pc.list_value_length(b.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.repeat(np.cumsum(in_doc) - in_doc, words_in)
        own = before[rare] - 1 - at[rare]
        n, begin = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n[rare], begin[rare] = own_size[own], own_start[own]
        known = at[~rare]
        begin[~rare] = starts[known]
        n[~rare] = starts[known + 1] - starts[known]
        stop = np.cumsum(n)
        source = np.repeat(begin - (stop - n), n) + np.arange(int(stop[-1]) if len(stop) else 0)
        out, from_own = np.empty(len(source), "<u4"), np.repeat(rare, n)
        out[from_own], out[~from_own] = own_pool[source[from_own]], pool[source[~from_own]]
        return out, np.concatenate(([0], stop))[np.concatenate(([0], np.cumsum(words_in)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, GROUP):
                b = whole.slice(a, GROUP)
                ids, ends = laid(b)
                counts = pa.array(np.diff(ends).astype(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), counts, _binary(ids, ends)], ["row", "n_tokens", "ids"])

    row = marked.schema["row"].dataType.simpleString()
    return marked.select("row", "known", "rare", "ids").mapInArrow(tidy(run), f"row {row}, n_tokens long, ids binary")


def _tokens(docs: DataFrame, path: str, pattern: str, text_col: str, most: int) -> DataFrame:
    """(row, n_tokens, ids): every row of ``docs`` as a struct, and the ids of its text.

    Words are several times larger than their text, so the session's Arrow batches are held to
    ``BATCH_BYTES`` from here on.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    fold = Fold(path)
    words, starts, pool = frequent_words(docs, fold, pattern, text_col, most)
    relieve(docs.sparkSession)
    marked = fold.encoded(_marked(docs, pattern, text_col, words), F.col("rare"), "ids")
    return _laid_out(marked, starts, pool, read_ranks(path))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           most: int = FREQUENT) -> DataFrame:
    """doc_id, n_tokens and ids of every text by the rank file at ``path``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _tokens(docs, path, pattern, "text", most).select("row.doc_id", "n_tokens", "ids")


def encode_rows(docs: DataFrame, path: str, pattern: str, text_col: str = "text", most: int = FREQUENT) -> DataFrame:
    """``docs`` with its text replaced by ``n_tokens`` and ``ids``; columns of these names get a prefix."""
    kept = [c for c in docs.columns if c != text_col]
    names = [fresh(docs.select(*kept), n) for n in ("n_tokens", "ids")]
    out = _tokens(docs, path, pattern, text_col, most)
    return out.select(*(F.col("row")[c].alias(c) for c in kept), *(F.col(a).alias(b) for a, b in zip(("n_tokens", "ids"), names, strict=True)))


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``tokens`` with ``out``: the bytes of the ids."""
    ranks = read_ranks(path)
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    table = pa.array(pieces, pa.binary())

    def joined(ids: pa.Array) -> pa.Array:
        """The pieces of all ids of a batch one after the other, cut where its documents end."""
        ids = pc.fill_null(ids, b"")
        if not len(ids):
            return pa.array([], pa.binary())
        ends, data = np.frombuffer(ids.buffers()[1], "<i4")[ids.offset : ids.offset + len(ids) + 1], ids.buffers()[2]
        if ((ends - ends[0]) % 4).any():
            raise ValueError("ids are 32-bit numbers")
        numbers = np.frombuffer(data or b"", "<u4", (ends[-1] - ends[0]) // 4, ends[0] if data else 0)
        text = table.take(pa.array(numbers))
        stops = np.frombuffer(text.buffers()[1], "<i4")[text.offset :] if len(text) else np.zeros(1, "<i4")
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(stops[(ends - ends[0]) // 4]), text.buffers()[2]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column(out, joined(b.column(b.schema.get_field_index(ids_col))))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema)
    return tokens.mapInArrow(tidy(run), f"{fields}, `{out}` binary")


def packed(ids: list[int]) -> bytes:
    """Ids as the binary column holds them."""
    return struct.pack(f"<{len(ids)}I", *ids)
