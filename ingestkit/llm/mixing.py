"""Mixing sources to target weights by min-cost flow.

Documents may belong to several sources. They are aggregated by membership pattern (the sorted set of
their sources); each pattern offers its words once at no cost and again at one unit per repetition, and
sources demand their targets. A min-cost flow from patterns to sources meets the targets with the least
repetition. A source that no shared pattern reaches is met by its own pattern alone, which takes no search;
the flow over the rest runs on the driver, over at most ``MAX_PATTERNS`` shared patterns (more is an error,
never a cut).

A pattern that has to give ``f`` of its ``c`` words gives every document ``f // c`` times, and once more
the documents first in a seeded order, until the rest ``f % c`` is met as closely as whole documents
allow. The order is an md5 digest of the seed, id and text. The cut-off digest of a pattern is found
from the totals of 4,096 digest ranges and, inside the one range that holds it, a running sum over distinct
digests. Rows that repeat id and text share a digest; where the cut falls among them, as many of them are
taken as the rest asks for, counted by the blocks of their row numbers. So no pattern and no group of copies
is gathered in one place; taking any other document is a comparison within the row.

Defined results: null texts have no words and are never taken; a null source is a source of its own,
the last in order; an empty table gives no rows; rows that repeat id and text are interchangeable. Reruns
agree up to such rows, as nothing else depends on the order of rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ingestkit.llm.common import fresh, with_row_id, words, written

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MAX_REPEAT = 2
SEED = "mix"
MAX_PATTERNS = 10_000
#: Rows of a table with a row per pattern or source up to which it is broadcast.
FEW = 100_000

Source = str | None


def ordered(sources: Sequence[Source]) -> list[Source]:
    """By code point, null last."""
    return sorted(set(sources), key=lambda s: (s is None, s or ""))


def targets(sizes: Mapping[Source, int], weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE,
            most: int = MAX_REPEAT) -> dict[Source, Fraction]:
    """Shares of ``share`` times all words by weight; a source stops at ``most`` times its size and the
    excess is shared again by weight until none is above."""
    order = ordered(list(sizes))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, out, open_ = share * sum(sizes.values()), {}, order
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if Fraction(weight[s], total) * left > most * sizes[s]]
        if not full:
            return out | {s: Fraction(weight[s], total) * left for s in open_}
        out |= {s: Fraction(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


@dataclass
class Flow:
    """Min-cost flow by successive shortest paths over a small graph."""

    arcs: list[list[int]] = field(default_factory=list)  # to, room, cost; arc ^ 1 is its reverse
    out: dict[object, list[int]] = field(default_factory=dict)

    def arc(self, a: object, b: object, room: int, cost: int = 0) -> int:
        for u, v, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out.setdefault(u, []).append(len(self.arcs))
            self.out.setdefault(v, [])
            self.arcs.append([v, r, c])
        return len(self.arcs) - 2

    def solve(self, source: object, sink: object) -> None:
        while True:
            dist, via, queue, queued = {source: 0}, {}, deque([source]), {source}
            while queue:
                u = queue.popleft()
                queued.discard(u)
                for e in self.out.get(u, ()):
                    v, room, cost = self.arcs[e]
                    if room and dist[u] + cost < dist.get(v, 1 << 60):
                        dist[v], via[v] = dist[u] + cost, (u, e)
                        if v not in queued:
                            queue.append(v)
                            queued.add(v)
            if sink not in via:
                return
            path, v = [], sink
            while v != source:
                u, e = via[v]
                path.append(e)
                v = u
            push = min(self.arcs[e][1] for e in path)
            for e in path:
                self.arcs[e][1] -= push
                self.arcs[e ^ 1][1] += push


def route(capacity: Mapping[tuple[Source, ...], int], target: Mapping[Source, Fraction],
          most: int = MAX_REPEAT) -> dict[tuple[Source, ...], int]:
    """Words each pattern gives: whole-word targets met with the least repetition."""
    g = Flow()
    shared = {s for p in capacity if len(p) > 1 for s in p}
    alone = {p for p in capacity if not shared.intersection(p)}
    given = dict.fromkeys(capacity, 0) | {p: min(int(target[p[0]]), most * capacity[p]) for p in alone if p}
    for p in capacity.keys() - alone:
        for again in range(most):
            g.arc("from", ("pattern", p), capacity[p], again)
        for s in p:
            g.arc(("pattern", p), ("source", s), most * capacity[p])
    for s in shared:
        g.arc(("source", s), "to", int(target[s]))
    g.solve("from", "to")
    for p in capacity.keys() - alone:
        for e in g.out[("pattern", p)]:
            if e % 2 == 0:
                given[p] += g.arcs[e ^ 1][1]
    return given


def _digest(id_: Column, text: Column, seed: str) -> Column:
    body = F.coalesce(text, F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("null")), F.lit(":"), F.md5(body)))


def measured(docs: DataFrame, id_col: str, text_col: str, members: Column, seed: str = SEED) -> DataFrame:
    """doc_id, size, pattern (JSON of the sorted set of sources) and digest of every row."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        F.array_sort(F.array_distinct(members)).alias("members"),
        _digest(F.col(id_col), F.col(text_col), seed).alias("digest"),
    ).withColumn("pattern", F.to_json("members"))


def numbered(rows: DataFrame, groups: Sequence[str], row_id: str, out: str) -> DataFrame:
    """``rows`` with their rank from 1 within a group by ``row_id``, from counts of the ids' blocks: only the
    rows of one block, which come from one partition, meet in a task."""
    block = fresh(rows, "block")
    rows = rows.withColumn(block, F.shiftright(row_id, 33))
    counts = rows.groupBy(*groups, block).agg(F.count(F.lit(1)).alias("k"))
    earlier = W.partitionBy(*groups).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(*groups, block, F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias("k"))
    inside = F.row_number().over(W.partitionBy(*groups, block).orderBy(row_id))
    return rows.withColumn(out, inside).join(counts, [*groups, block]).withColumn(out, F.col(out) + F.col("k")).drop("k", block)


def _few(table: DataFrame, rows: int) -> DataFrame:
    """A table of ``rows`` rows, one per pattern or source, marked for a broadcast where that is at most FEW; beyond,
    the join shuffles, and a source that holds many rows is split by the adaptive skew join."""
    return F.broadcast(table) if rows <= FEW else table


@dataclass(frozen=True)
class Mix:
    """Per pattern: times every document is taken, the last digest that is taken once more whole, and a digest
    of whose rows ``some`` are."""

    plan: DataFrame  # pattern, times, last, part, some; a row per pattern
    sizes: dict[Source, int]
    targets: dict[Source, Fraction]
    patterns: int

    def times(self, rows: DataFrame) -> DataFrame:
        """``rows`` (pattern, digest, size and any more) with ``times``."""
        plan = self.plan.withColumnRenamed("times", "base")
        joined = rows.join(_few(plan, self.patterns), "pattern")
        cut = F.coalesce(F.col("digest") == F.col("part"), F.lit(False))
        more = F.when(F.col("digest") <= F.col("last"), F.lit(1)).otherwise(F.lit(0))
        every = joined.where(~cut).withColumn("more", more).drop("part", "some", "last")
        if not self.plan.where("part IS NOT NULL").isEmpty():  # no cut falls among equal rows, as a rule
            rid, rank = fresh(rows, "row_id"), fresh(rows, "rank")
            among = written(with_row_id(joined.where(cut).drop("last"), rid), "cut")
            among = numbered(among, ["pattern", "digest"], rid, rank)
            among = among.withColumn("more", F.when(F.col(rank) <= F.col("some"), F.lit(1)).otherwise(F.lit(0)))
            every = every.unionByName(among.drop("part", "some", rid, rank))
        times = F.when(F.col("size") > 0, F.col("base") + F.col("more")).otherwise(F.lit(0)).cast("long")
        return every.withColumn("times", times).drop("base", "more")


def plan_mix(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most: int = MAX_REPEAT) -> Mix:
    """The flow over the patterns of ``rows`` (from ``measured``, written) and each pattern's cut-off."""
    spark = rows.sparkSession
    totals = rows.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("words"))
    if totals.where(F.size("members") > 1).limit(MAX_PATTERNS + 1).count() > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns share sources; group small sources first")
    found = totals.collect()  # a row per source, and the shared patterns
    capacity = {tuple(r["members"]): r["words"] for r in found}
    name = {tuple(r["members"]): r["pattern"] for r in found}
    sizes: dict[Source, int] = {}
    for p, n in capacity.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    target = targets(sizes, weights, share, most)
    given = route(capacity, target, most)
    need = [(name[p], given[p] // c if c else 0, given[p] % c if c else 0) for p, c in capacity.items()]
    needs = spark.createDataFrame(need, "pattern string, times long, rest long")
    part = F.substring("digest", 1, 3)
    ranges = rows.groupBy("pattern", part.alias("part")).agg(F.sum("size").alias("n"))
    upto = W.partitionBy("pattern").orderBy("part").rowsBetween(W.unboundedPreceding, 0)
    edge = (
        ranges.withColumn("upto", F.sum("n").over(upto))
        .join(_few(needs, len(need)), "pattern")
        .where("upto > rest and upto - n <= rest")
        .select("pattern", "part", (F.col("upto") - F.col("n")).alias("before"), "rest")
    )
    edge = written(edge, "edge")
    near = rows.where("size > 0").withColumn("part", part).join(_few(edge, len(need)), ["pattern", "part"])
    near = near.groupBy("pattern", "digest", "before", "rest", "size").agg(F.count(F.lit(1)).alias("k"))
    inside = W.partitionBy("pattern").orderBy("digest").rowsBetween(W.unboundedPreceding, -1)
    sofar = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("k")).over(inside), F.lit(0))
    # of k equal rows those are taken whose middle is not beyond the rest
    fit = F.call_function("div", F.col("rest") * 2 - sofar * 2 - F.col("size"), F.col("size") * 2) + 1
    fit = F.when(sofar * 2 + F.col("size") <= F.col("rest") * 2, F.least(fit, F.col("k"))).otherwise(F.lit(0))
    near = near.withColumn("fit", fit)
    last = near.groupBy("pattern").agg(
        F.max(F.when(F.col("fit") == F.col("k"), F.col("digest"))).alias("last"),
        F.max(F.when((F.col("fit") > 0) & (F.col("fit") < F.col("k")), F.struct("digest", "fit"))).alias("cut"),
    )
    # nothing taken inside the edge range: what lies before the range is
    plan = needs.join(edge.select("pattern", F.col("part").alias("range")), "pattern", "left").join(last, "pattern", "left")
    plan = plan.select("pattern", "times", F.coalesce("last", "range").alias("last"), F.col("cut.digest").alias("part"), F.col("cut.fit").alias("some"))
    return Mix(written(plan, "plan"), sizes, target, len(need))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted), one row per input row."""
    rows = written(measured(docs, id_col, text_col, F.array(F.col(source_col))), "sizes")
    mix = plan_mix(rows)
    spark = docs.sparkSession
    facts = [(s, n, float(mix.targets[s])) for s, n in mix.sizes.items()]
    facts = spark.createDataFrame(facts, "source string, source_size long, target double")
    taken = mix.times(rows).withColumn("source", F.col("members")[0])
    return taken.join(_few(facts, len(mix.sizes)), taken["source"].eqNullSafe(facts["source"])).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken, columns unchanged."""
    members = F.array(F.col(source_col))
    mix = plan_mix(written(measured(docs, id_col, text_col, members), "sizes"))
    keyed = docs.select(
        F.struct("*").alias("doc"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        F.to_json(F.array_sort(F.array_distinct(members))).alias("pattern"),
        _digest(F.col(id_col), F.col(text_col), SEED).alias("digest"),
    )
    copies = mix.times(keyed).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return copies.select("doc.*")


ORACLE = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
  md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, [{", ".join(map(str, WEIGHTS))}]
  [1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS w FROM d GROUP BY source),
r AS (SELECT *, 3 * sum(n) OVER () - 2 * coalesce(sum({MAX_REPEAT} * n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS twice_left,
  sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left
  FROM s WINDOW o AS (ORDER BY n / w, source NULLS LAST)),
c AS (SELECT *, w * twice_left > 2 * {MAX_REPEAT} * n * w_left AS full_ FROM r),
u AS (SELECT min(twice_left) FILTER (NOT full_) AS l, max(w_left) FILTER (NOT full_) AS wl FROM c),
t AS (SELECT source, n, CASE WHEN full_ THEN ({MAX_REPEAT} * n)::DOUBLE
    ELSE (w * first_left)::DOUBLE / (2 * first_w)::DOUBLE END AS target,
  CASE WHEN full_ THEN {MAX_REPEAT} * n ELSE (w * first_left) // (2 * first_w) END AS f
  FROM c, (SELECT twice_left AS first_left, w_left AS first_w FROM c WHERE NOT full_ ORDER BY n / w, source NULLS LAST LIMIT 1)),
p AS (SELECT d.*, t.n, t.target, t.f, sum(d.size) OVER (PARTITION BY d.source ORDER BY digest ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, target,
  CAST(CASE WHEN size = 0 THEN 0 ELSE size * (f // n + CASE WHEN 2 * before + size <= 2 * (f % n) THEN 1 ELSE 0 END) END AS BIGINT) AS taken
FROM p"""
