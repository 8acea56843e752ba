"""Sharding by global byte-size prefix sums.

Documents are put in the order of their id. Each range partition sums its sizes, the totals of the
earlier ranges shift the running sums, and document ``i`` with ``p`` bytes before it goes to the shard
in which its middle byte lies: ``(p + size / 2) * shards / total``, in integers. Shards are contiguous
in the order and their sizes differ from the target by at most one document.

Only (id, size, checksum) rows are shuffled. Null texts have no bytes and a size of 8; null ids come
first; rows with equal ids are ordered by size and checksum, and rows equal in all three are
interchangeable. An empty table gives no rows. The law of the split is ``bytes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import global_order, written

SHARDS = 24
ROW_BYTES = 8


def shards(docs: DataFrame, n: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (position in the shard), grown_shard (null)."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    sizes = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    placed = written(global_order(sizes, [F.col("doc_id"), F.col("size"), F.col("text_crc32")], ["size"]), "placed")
    total = placed.agg(F.sum("size")).first()[0] or 1
    cut = placed.select(
        "doc_id", "size", "text_crc32", "idx",
        F.expr(f"int(((2 * before_size + size) * {n}) div (2 * {total}L))").alias("shard"),
    )
    first = cut.groupBy("shard").agg(F.min("idx").alias("first_idx"))  # at most n rows
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("idx") - F.col("first_idx")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: CRC-32 is folded over the half-bytes of the text, low half first, by the rule's 16-entry table.
ORACLE = f"""
WITH t AS (SELECT list_transform(range(16), lambda b: list_reduce(list_prepend(b, range(4)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
h AS (SELECT doc_id, strlen(coalesce(text, '')) + {ROW_BYTES} AS size,
  string_split(hex(encode(coalesce(text, ''))), '') AS x FROM documents),
n AS (SELECT doc_id, size, list_transform(range(1, 2 * (size - {ROW_BYTES}) + 1), lambda i:
    CAST(strpos('0123456789ABCDEF', x[i + 2 * (i % 2) - 1]) - 1 AS BIGINT)) AS half FROM h),
d AS (SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295, half), lambda c, k:
    xor(t.crc[(xor(c, k) & 15) + 1], c >> 4))) AS text_crc32 FROM n, t),
p AS (SELECT *, row_number() OVER w - 1 AS idx,
  (2 * CAST(sum(size) OVER w AS HUGEINT) - size) * {SHARDS} // (2 * sum(size) OVER ()) AS shard
  FROM d WINDOW w AS (ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING))
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INT) AS shard,
  idx - min(idx) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INT) AS grown_shard
FROM p"""
