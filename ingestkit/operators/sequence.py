"""Ordered neighbours within a key, in tasks of a bounded part of the rows.

``with_neighbors`` adds, for each row, values of the previous and next row of
the same key in a total order. A plain ``Window.partitionBy(key)`` sends every
row of a key to one task; when one key holds a large share of the rows that
task becomes the whole job. Here all rows are cut into ranges of (key, order)
at sampled rows (``range_cuts``). A key that holds two cuts or more, so about a
whole range of rows, is divided at them and the window runs over (key, range);
other keys are windows of their own, whatever range they begin in. A divided
key carries its ends over: the first and last row of each of its ranges take
their missing neighbour from the adjacent range.

Sizes: there are at most MAX_RANGES cuts, a divided key has one range more than
cuts, and the table of range ends, which is broadcast, has a row for each. The
sample has about SAMPLES_PER_RANGE rows per cut and is one pass over the keys
and order columns; rows of keys that are not divided are not searched for.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

# Tuning values (not semantics): rows of a range, the most ranges, and the rows
# sampled per range to place the cuts.
RANGE_ROWS = 4_000_000
MAX_RANGES = 8_191
SAMPLES_PER_RANGE = 8


@dataclass(frozen=True)
class Cuts:
    """At most MAX_RANGES starts of ranges, as JSON of an array of (keys, order), the array's type, and the hashes
    of the keys that hold two or more of them."""

    text: str
    kind: ArrayType
    divided: tuple[int, ...] = ()

    def starts(self) -> Column:
        """The starts as a literal, sorted here: whatever JSON makes of a value, the ranges are in order."""
        return F.array_distinct(F.sort_array(F.from_json(F.lit(self.text), self.kind)))


def range_cuts(df: DataFrame, keys, order, range_rows: int = RANGE_ROWS) -> Cuts | None:
    """The starts of the ranges, values of (keys, order) of sampled rows; None where all rows are one range.

    Compared as structs, nulls first, which is how the windows sort: any
    orderable columns work, and where the cuts lie changes only the balance,
    never the outcome. One job samples the rows, without a shuffle of them; the
    cuts are then a literal of the later plans, so all passes over the rows see
    the same ranges.
    """
    keys, order = list(keys), list(order)
    sample = df.where(F.rand(7) < F.lit(SAMPLES_PER_RANGE / range_rows)).select(_seq(keys + order).alias("at"))
    starts = sample.agg(F.array_sort(F.collect_list("at")).alias("s"))
    step = F.greatest(F.lit(max(1, min(SAMPLES_PER_RANGE, range_rows))), F.ceil(F.size("s") / F.lit(MAX_RANGES))).cast("int")
    table = starts.select(F.filter("s", lambda x, i: (i + 1) % step == 0).alias("cuts"))
    key = lambda x: F.struct(*[x[f"c{i}"] for i in range(len(keys))])
    again = F.filter("cuts", lambda x, i: (i > 0) & F.coalesce(key(x).eqNullSafe(key(F.get("cuts", i - 1))), F.lit(False)))
    hashes = F.array_distinct(F.transform(again, lambda x: F.xxhash64(*[x[f"c{i}"] for i in range(len(keys))])))
    text, divided = table.select(F.to_json("cuts"), hashes).first()
    return None if text == "[]" else Cuts(text, table.schema["cuts"].dataType, tuple(divided))


def _seq(columns):
    return F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])


def _on_keys(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the key columns of ``left`` stay."""
    renamed = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_k_{k}" for k in keys])


def _tag(df: DataFrame, cuts: Cuts, keys, order) -> DataFrame:
    """``_cut``: the row's key is divided (or shares the hash of one that is); and ``_sub``, then the number of cuts
    at or before the row, else 0."""
    # binary search as one expression: a filter pushed below it copies it once, not once per step
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(MAX_RANGES.bit_length()))])
    state = F.struct(F.lit(0).alias("at"), cuts.starts().alias("starts"), _seq(keys + order).alias("row"))

    def halve(s, step):
        ahead = F.coalesce(F.get(s["starts"], s["at"] + step - 1) <= s["row"], F.lit(False))
        return s.withField("at", F.when(ahead, s["at"] + step).otherwise(s["at"]))

    divided = F.xxhash64(*keys).isin(*cuts.divided)
    at = F.when(divided, F.aggregate(steps, state, halve, lambda s: s["at"])).otherwise(F.lit(0))
    return df.withColumns({"_sub": at, "_cut": divided})


AUTO = "auto"


def with_neighbors(
    df: DataFrame,
    keys,
    order,
    prev_cols=(),
    next_cols=(),
    range_rows: int = RANGE_ROWS,
    cuts="auto",
) -> DataFrame:
    """Add ``_prev_<c>`` / ``_next_<c>`` and the flags ``_is_first`` / ``_is_last``.

    ``order`` must be a total order within a key (add a tie-break column).
    ``cuts`` may be passed in (the result of ``range_cuts``) to share the
    ranges between passes over subsets of the same rows.
    """
    keys, order = list(keys), list(order)
    prev_cols, next_cols = list(prev_cols), list(next_cols)
    if isinstance(cuts, str) and cuts == AUTO:
        cuts = range_cuts(df, keys, order, range_rows)

    def neighbours(frame, partition):
        w = Window.partitionBy(*partition).orderBy(*order)
        cols = {f"_prev_{c}": F.lag(c).over(w) for c in prev_cols}
        cols.update({f"_next_{c}": F.lead(c).over(w) for c in next_cols})
        cols["_is_first"] = F.lag(F.lit(1)).over(w).isNull()
        cols["_is_last"] = F.lead(F.lit(1)).over(w).isNull()
        return frame.withColumns(cols)

    if cuts is None or not cuts.divided:
        # No ends to carry.
        return neighbours(df, keys)
    tagged = _tag(df, cuts, keys, order)
    local = neighbours(tagged, keys + ["_sub"])

    # Ends of the divided keys: a row per key and range, combined before the shuffle.
    payload = F.struct(*[F.col(c) for c in dict.fromkeys(prev_cols + next_cols)])
    ends = (
        tagged.where("_cut")
        .groupBy(*keys, "_sub")
        .agg(F.min_by(payload, _seq(order)).alias("_lo"), F.max_by(payload, _seq(order)).alias("_hi"))
    )
    wb = Window.partitionBy(*keys).orderBy("_sub")
    bounds = ends.select(*keys, "_sub", F.lag("_hi").over(wb).alias("_before"), F.lead("_lo").over(wb).alias("_after"))
    # a row per range of a divided key
    joined = _on_keys(local, F.broadcast(bounds), keys + ["_sub"], "left")
    fixes = {}
    for c in prev_cols:
        name = f"_prev_{c}"
        fixes[name] = F.when(F.col("_is_first"), F.col(f"_before.{c}")).otherwise(F.col(name))
    for c in next_cols:
        name = f"_next_{c}"
        fixes[name] = F.when(F.col("_is_last"), F.col(f"_after.{c}")).otherwise(F.col(name))
    fixes["_is_first"] = F.col("_is_first") & F.col("_before").isNull()
    fixes["_is_last"] = F.col("_is_last") & F.col("_after").isNull()
    return joined.withColumns(fixes).drop("_before", "_after", "_cut", "_sub")


def fill_forward(
    df: DataFrame,
    keys,
    order,
    value: str,
    range_rows: int = RANGE_ROWS,
    cuts="auto",
    out: str = "_filled",
) -> DataFrame:
    """Add ``out``: the last non-null ``value`` at or before each row within its key.

    Cut like ``with_neighbors``: a divided key is filled inside each of its ranges,
    then a row with nothing before it in its range takes the last value of the
    key's earlier ranges.
    """
    keys, order = list(keys), list(order)
    if isinstance(cuts, str) and cuts == AUTO:
        cuts = range_cuts(df, keys, order, range_rows)

    def local(frame, partition):
        w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return frame.withColumn(out, F.last(F.col(value), ignorenulls=True).over(w))

    if cuts is None or not cuts.divided:
        return local(df, keys)
    tagged = _tag(df, cuts, keys, order)
    filled = local(tagged, keys + ["_sub"])
    # every range of a divided key, so that one without values still learns what came before it
    ends = (
        tagged.where("_cut")
        .groupBy(*keys, "_sub")
        .agg(F.max_by(F.struct(F.col(value).alias("_v")), F.when(F.col(value).isNotNull(), _seq(order))).alias("_m"))
    )
    wb = Window.partitionBy(*keys).orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*keys, "_sub", F.last(F.col("_m._v"), ignorenulls=True).over(wb).alias("_carry"))
    # a row per range of a divided key
    joined = _on_keys(filled, F.broadcast(carry), keys + ["_sub"], "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.col("_carry"))).drop("_carry", "_cut", "_sub")
