"""Source divergence audit by Gustavson row accumulation.

Per language, the smoothed term shares of every source are compared with those of every other source and of
the language. The terms that sources share are kept term-major: one index row per term with the sources that
have it. The index is dealt out by term; a task takes its rows in blocks of at most ``BLOCK`` postings, and
for each source of a block scatters the source's terms through the index into one dense accumulator with a
place per peer. What leaves a block is one number per source and peer, never a pair of postings, and partial
numbers are added up before they are shuffled.

The accumulators hold the shared terms only. A term that just one of two sources has, or neither, still
counts, as smoothing gives absent terms a share as well (the zero baseline). With f(x, y) the summand, x0
and y0 the two baselines, a pair (A, B) over V terms is therefore

    sum over A of f(x, y0) + sum over B of f(x0, y) + (V - |A| - |B|) f(x0, y0)
      + sum over shared terms of f(x, y) - f(x, y0) - f(x0, y) + f(x0, y0).

The first two sums need only how often each share occurs in a source, which is few numbers. All arithmetic
is in whole numbers: counts and sums over terms as decimals, shares and summands as longs.

Defined results: null texts, languages and sources count as empty strings; texts without terms still make
their group occur; repeated rows and ids are documents of their own; a language without a kept term gives
pairs of value 0 and no terms; a language with one source gives no pairs; an empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ingestkit.llm.common import tidy, written

MIN_DOCS = 10
UNIT = 1_000_000_000
TOP_TERMS = 10
#: The code points that separate terms, as ranges.
SEPARATORS = ((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Distinct terms counted in a task before their counts leave it.
COUNTED = 200_000
#: Postings that are accumulated at a time.
BLOCK = 1 << 19

_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
_TABLE = bytes(0x20 if any(a <= c <= b for a, b in SEPARATORS) else _LOWER.get(c, c) for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text, both in UTF-8, only A-Z lower-cased."""
    return (text or b"").translate(_TABLE).split()


def counted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents per group and term; a null term marks a group.

    Every task counts its own documents first and lets its counts go when it holds ``COUNTED`` terms.
    """

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in held.items():
            names = pa.array([*n, None], pa.binary()).cast(pa.string())
            columns = [pa.array([x] * len(names), pa.string()) for x in (lang, source)]
            counts = (pa.array([*n.values(), 0], pa.int64()), pa.array([*(d[t] for t in n), 0], pa.int64()))
            yield pa.RecordBatch.from_arrays([*columns, names, *counts], ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for b in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                found, before = terms(text), len(n)
                n.update(found)
                d.update(set(found))
                size += len(n) - before + 1
                if size > COUNTED:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    names = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col))
    body = docs.select(*names, F.col(text_col).cast("string").cast("binary"))
    parts = body.mapInArrow(tidy(run), "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms_: Column) -> Column:
    """1 + floor(UNIT (count + 2) / (total + 2 terms)); decimals, as the product may pass a long."""
    over = (count.cast("decimal(28,0)") + F.lit(2)) * F.lit(UNIT).cast("decimal(10,0)")
    under = (total.cast("decimal(30,0)") + F.lit(2).cast("decimal(1,0)") * terms_.cast("decimal(20,0)")).cast("decimal(38,0)")
    names = {"over": over.cast("decimal(38,0)"), "under": under}
    s = F.struct(*(c.alias(k) for k, c in names.items()))
    return F.element_at(F.transform(F.array(s), lambda z: F.lit(1).cast("long") + F.call_function("div", z["over"], z["under"])), 1)


def _summand(p: np.ndarray | int, q: np.ndarray | int) -> np.ndarray | int:
    """floor((p - q)^2 / (p + q)); shares are at most UNIT + 1, so the square fits a long."""
    return (p - q) * (p - q) // (p + q)


def groups(counts: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(kept, facts): counts of kept terms with their count in the language; and per group its number ``g``
    in the language (from 0, by source), baseline share ``p0``, and the language's ``terms`` and ``peers``."""
    by_term = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("lang_n"))
    by_term = written(by_term.where(F.col("d") >= min_docs).drop("d"), "terms")
    total = F.sum(F.col("lang_n").cast("decimal(38,0)"))
    langs = by_term.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), total.alias("lang_total"))
    kept = written(counts.where("n > 0").join(by_term, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept")
    sizes = kept.groupBy("lang", "source").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("total"), F.count(F.lit(1)).alias("own"))
    seen = counts.where("term is null").select("lang", "source")
    all_ = seen.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["own", "terms"])
    zero = F.lit(0).cast("decimal(38,0)")
    facts = all_.select(
        "lang",
        "source",
        F.coalesce("total", zero).alias("total"),
        "own",
        "terms",
        F.coalesce("lang_total", zero).alias("lang_total"),
        (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).alias("g"),
        F.count(F.lit(1)).over(W.partitionBy("lang")).cast("int").alias("peers"),
    )
    p0 = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms")))
    return kept, written(facts.withColumn("p0", F.coalesce(p0, F.lit(0))), "facts")


def shared(index: DataFrame) -> DataFrame:
    """(lang, a, b, value): what shared terms add to pairs, from index rows (lang, peers, g, p, p0) with one
    array element per source of the term."""

    def block(lang: str, peers: int, g: np.ndarray, p: np.ndarray, p0: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        """Postings sorted by term; ``starts`` has the first one of every term and their number at the end."""
        lengths = np.diff(starts)
        of_term = np.repeat(np.arange(len(lengths)), lengths)
        order = np.argsort(g, kind="stable")
        cuts = np.flatnonzero(np.diff(g[order])) + 1
        a, b, value = [], [], []
        for mine in np.split(order, cuts):
            row = np.zeros(peers, np.int64)  # the dense accumulator of one source
            t = of_term[mine]
            step = max(1, BLOCK // max(1, int(lengths[t].max())))
            for at in range(0, len(mine), step):  # a common term is in every source: scatter in steps
                some, tt = mine[at : at + step], t[at : at + step]
                n = lengths[tt]
                first = np.repeat(starts[tt] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
                peer = first + np.arange(n.sum())
                x, x0, y, y0 = np.repeat(p[some], n), p0[some[0]], p[peer], p0[peer]
                np.add.at(row, g[peer], _summand(x, y) - _summand(x, y0) - _summand(x0, y) + _summand(x0, y0))
            there = np.flatnonzero(row)
            a.append(np.full(len(there), g[mine[0]]))
            b.append(there)
            value.append(row[there])
        ids = [np.concatenate(v).astype(np.int32) for v in (a, b)]
        names = pa.array([lang] * len(ids[0]), pa.string())
        return pa.RecordBatch.from_arrays([names, *map(pa.array, ids), pa.array(np.concatenate(value))], ["lang", "a", "b", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def done(lang: str) -> pa.RecordBatch:
            peers, _, parts, lengths = held.pop(lang)
            g, p, p0 = (np.concatenate([x[i] for x in parts]) for i in range(3))
            return block(lang, peers, g, p, p0, np.concatenate(([0], np.cumsum(np.concatenate(lengths)))))

        for whole in batches:
            langs = np.array(whole.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                mine = whole.filter(pa.array(langs == lang))
                size = mine.column(2).value_lengths().to_numpy()
                flat = [mine.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3, 4)]
                ends = np.cumsum(size)
                cuts = [0, *(np.flatnonzero(np.diff(ends // BLOCK)) + 1), len(size)]
                for i, j in zip(cuts, cuts[1:], strict=False):
                    if i == j:
                        continue
                    lo, hi = ends[i] - size[i], ends[j - 1]
                    entry = held.setdefault(lang, [mine.column(1)[0].as_py(), 0, [], []])
                    entry[1] += hi - lo
                    entry[2].append([x[lo:hi] for x in flat])
                    entry[3].append(size[i:j])
                    if entry[1] >= BLOCK:
                        yield done(lang)
        for lang in sorted(held):
            yield done(lang)

    return index.select("lang", "peers", "g", "p", "p0").mapInArrow(tidy(run), "lang string, a int, b int, value long")


def baselines(histogram: DataFrame, facts: DataFrame) -> DataFrame:
    """(lang, a, b, value): the sums over A of f(x, y0) and over B of f(x0, y), from rows (lang, g, p, times).

    A row per source with its different shares meets the baselines of its peers; the numbers of both are in
    proportion to the root of the source's words and to the result.
    """
    own = histogram.groupBy("lang", "g").agg(F.collect_list(F.struct("p", "times")).alias("own"))
    peers = facts.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("g", "p0"))).alias("peers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, g, own_, peers_ in zip(*(c.to_pylist() for c in b.columns), strict=True):
                y0 = np.array([x["p0"] for x in peers_], np.int64)
                row = np.zeros(len(y0), np.int64)
                for x in own_:
                    row += x["times"] * _summand(np.int64(x["p"]), y0)
                other = np.array([x["g"] for x in peers_], np.int32)
                me = np.full(len(other), g, np.int32)
                for a, c in ((me, other), (other, me)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(other), pa.string()), pa.array(a), pa.array(c), pa.array(row)], ["lang", "a", "b", "value"]
                    )

    return own.join(peers, "lang").select("lang", "g", "own", "peers").mapInArrow(tidy(run), "lang string, a int, b int, value long")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank."""
    counts = written(counted(docs, text_col, lang_col, source_col), "counts")
    kept, facts = groups(counts, min_docs)
    shares = kept.join(facts, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "g",
        "p0",
        "peers",
        _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    shares = written(shares, "shares")

    # an index row has one element per source of the language, and sources are rows of the result
    posting = F.collect_list(F.struct("g", "p", "p0"))
    index = shares.groupBy("lang", "term").agg(F.first("peers").alias("peers"), posting.alias("posting"))
    index = index.select("lang", "peers", *(F.col(f"posting.{c}").alias(c) for c in ("g", "p", "p0")))
    histogram = shares.groupBy("lang", "g", "p").agg(F.count(F.lit(1)).alias("times"))
    parts = shared(index).unionByName(baselines(histogram, facts))
    value = F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    summed = parts.where("a <> b").groupBy("lang", "a", "b").agg(value)

    one = facts.select("lang", "terms", "source", F.col("g").alias("a"), F.col("own").alias("own_a"), F.col("p0").alias("p0_a"))
    two = facts.select("lang", F.col("source").alias("item"), F.col("g").alias("b"), F.col("own").alias("own_b"), F.col("p0").alias("p0_b"))
    # every pair of sources of a language is a row of the result
    pairs = one.join(two, "lang").where("a <> b").join(summed, ["lang", "a", "b"], "left")
    x, y = F.col("p0_a"), F.col("p0_b")
    square = (x - y) * (x - y)
    none = F.when(x + y > 0, F.call_function("div", square, F.when(x + y > 0, x + y).otherwise(F.lit(1)))).otherwise(F.lit(0))
    absent = (F.col("terms") - F.col("own_a") - F.col("own_b")).cast("decimal(20,0)") * none.cast("decimal(18,0)")
    pairs = pairs.select(
        "lang",
        "source",
        F.lit("pair").alias("part"),
        "item",
        (F.coalesce("value", F.lit(0).cast("decimal(38,0)")) + absent).cast("long").alias("value"),
    )
    p, q = F.col("p"), F.col("q")
    over = shares.where("p > q").select(
        "lang",
        "source",
        F.lit("term").alias("part"),
        F.col("term").alias("item"),
        F.call_function("div", (p - q) * (p - q), p + q).alias("value"),
    )
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).unionByName(
        over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    )
    return ranked.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
w AS MATERIALIZED (SELECT id, lang, source, unnest(ts) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  CAST(1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.total, 0) + 2 * l.v) AS BIGINT) AS p,
  CAST(1 + ({UNIT}::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS BIGINT) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= {TOP_TERMS}"""
