"""Quality rules: a threshold table compiled into one projection.

Every metric is a Spark SQL expression over the whole text and every rule is an integer comparison
``scale * metric <op> limit * base``, so the verdict is one boolean expression without user functions
and without a shuffle.

Null and empty texts have no words; all their counts are 0 and the base check fails them (fewer than
10 words). Null ids, ties, repeated rows and further columns do not matter: each row is judged alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import SPACES, let, words

#: Symbols of the contract's count, and the wider set of the verdict's ratio.
SYMBOLS = "#*$%&|<>"
WIDE_SYMBOLS = SYMBOLS + "!{}[]~^=_@+\\"
PUNCTUATION = ".,;:!?\"'()"
WINDOW = 5

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that for it as was with on by this are from or an be "
    "der die das und ist nicht ein eine mit den von zu auf im dem des "
    "le la les et des est un une dans pour que qui du en pas "
    "el los las y es una por con para del que no se"
).split()


@dataclass(frozen=True)
class Limit:
    """A document passes when ``low * base <= 1000 * metric <= high * base`` (per mille of ``base``)."""

    metric: str
    base: str
    low: int | None = None
    high: int | None = None


LIMITS = (
    Limit("word_chars", "n_words", low=2_000, high=12_000),
    Limit("n_words", "one", low=10_000, high=1_000_000_000),
    Limit("n_symbols", "n_words", high=100),
    Limit("n_wide_symbols", "n_words", high=300),
    Limit("n_stop_words", "n_words", low=10),
    Limit("n_dup_lines", "n_lines", high=300),
    Limit("n_bullet_lines", "n_lines", high=900),
    Limit("n_ellipsis_lines", "n_lines", high=300),
)


def _without(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def repeated_window_words(w: Column, size: int = WINDOW) -> Column:
    """Words lying in a ``size``-word window that occurs twice or more in the word array ``w``.

    Windows are first compared by hash: when all hashes differ, no window repeats. Otherwise the
    windows themselves are sorted with their positions; equal neighbours repeat, and each repeated
    start covers ``size`` words or as many as lie before the next repeated start.
    """

    def starts() -> Column:
        return F.sequence(F.lit(0), F.size(w) - size)

    hashes = F.transform(starts(), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))
    spelled = F.transform(
        starts(),
        lambda i: F.struct(F.concat_ws(" ", *(F.get(w, i + k) for k in range(size))).alias("s"), i.alias("i")),
    )

    def repeated(srt: Column) -> Column:
        same = F.filter(
            srt, lambda x, j: (F.get(srt, j - 1)["s"].eqNullSafe(x["s"])) | (F.get(srt, j + 1)["s"].eqNullSafe(x["s"]))
        )
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(size), F.coalesce(F.get(p, j + 1) - x, F.lit(size))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    exact = let(F.array_sort(spelled), lambda srt: let(repeated(srt), covered))
    any_repeat = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(w) < size, F.lit(0)).when(any_repeat, exact).otherwise(F.lit(0)).cast("long")


def metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with every metric the rules use."""
    raw = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    split = raw.select(
        "doc_id",
        "text",
        words(F.col("text")).alias("w"),
        F.filter(F.split("text", "\n", -1), lambda x: F.trim(F.translate(x, SPACES, " ")) != "").alias("lines"),
        F.split(F.translate(F.lower("text"), PUNCTUATION + SPACES, " " * len(PUNCTUATION + SPACES)), " ").alias("plain"),
    )
    bullets = F.filter("lines", lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•"))
    ellipses = F.filter("lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))
    return split.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        (F.char_length("text") - _without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        _without(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("w")).alias("n_repeat_words"),
        _without(F.col("text"), WIDE_SYMBOLS).cast("long").alias("n_wide_symbols"),
        F.size(F.filter("plain", lambda x: x.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(bullets).cast("long").alias("n_bullet_lines"),
        F.size(ellipses).cast("long").alias("n_ellipsis_lines"),
        F.lit(1).cast("long").alias("one"),
    )


def verdict(limits: tuple[Limit, ...] = LIMITS) -> Column:
    """The threshold table as one boolean expression."""
    out = F.lit(True)
    for r in limits:
        if r.low is not None:
            out = out & (F.lit(r.low) * F.col(r.base) <= 1000 * F.col(r.metric))
        if r.high is not None:
            out = out & (1000 * F.col(r.metric) <= F.lit(r.high) * F.col(r.base))
    return out


def quality_rules(docs: DataFrame, limits: tuple[Limit, ...] = LIMITS) -> DataFrame:
    """Metrics, the base check and the verdict, one row per input row."""
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        metrics(docs)
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~base_failed & verdict(limits))
        .drop("one")
    )


def oracle_sql(limits: tuple[Limit, ...] = LIMITS) -> str:
    """The same in DuckDB SQL."""
    checks = ["NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"]
    for r in limits:
        if r.low is not None:
            checks.append(f"{r.low} * {r.base} <= 1000 * {r.metric}")
        if r.high is not None:
            checks.append(f"1000 * {r.metric} <= {r.high} * {r.base}")

    def count(chars: str) -> str:
        return "length(text) - length(translate(text, '" + chars.replace("'", "''") + "', ''))"

    stop = ", ".join(f"'{x}'" for x in sorted(set(STOP_WORDS)))
    plain = (PUNCTUATION + SPACES).replace("'", "''")
    return f"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
  string_split(translate(lower(text), '{plain}', '{" " * len(PUNCTUATION + SPACES)}'), ' ') AS plain FROM d),
win AS (SELECT rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w)),
rep AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n FROM rep GROUP BY rid),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(text) - ({count(SPACES)}) AS BIGINT) AS word_chars,
  CAST({count(SYMBOLS)} AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
  CAST({count(WIDE_SYMBOLS)} AS BIGINT) AS n_wide_symbols,
  CAST(len(list_filter(plain, lambda x: x IN ({stop}))) AS BIGINT) AS n_stop_words,
  CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(len(list_filter(lines, lambda x: ltrim(x, ' ')[1:1] IN ('-', '*', chr(8226)))) AS BIGINT) AS n_bullet_lines,
  CAST(len(list_filter(lines, lambda x: suffix(rtrim(x, ' '), '...') OR suffix(rtrim(x, ' '), chr(8230)))) AS BIGINT)
    AS n_ellipsis_lines, 1 AS one
  FROM w LEFT JOIN cov USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_wide_symbols, n_stop_words, n_lines,
  n_bullet_lines, n_ellipsis_lines, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  ({" AND ".join(checks)}) AS kept
FROM m"""
