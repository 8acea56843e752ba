"""Exact de-duplication by deterministic block naming.

Texts are cut into fixed-size byte blocks. The distinct blocks are sorted and numbered, so each block
has an integer name and different blocks have different names. Adjacent names are then paired and the
distinct pairs numbered the same way, until every document has a single name. (number of blocks, name)
identifies a text without collisions.

Block texts are shuffled once, after a map-side distinct. Rows find the name of a block through a
64-bit routing key, which is checked to be one-to-one over the distinct blocks before it is used;
should two blocks ever share a key, the next key seed is tried. Joins run between written tables, so
adaptive execution can split a block, pair or text that a third of all rows share.

Defined results: null texts count as empty, and an empty text is one empty block. Of equal texts the
row with the largest id stays (a null id is smaller than any other); of rows that also repeat the id,
exactly one stays. Further columns are carried by ``drop_duplicates`` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import fresh, with_row_id, written

BLOCK_BYTES = 16_384
KEY_SEEDS = 8


def _blocks(body: Column, size: int) -> Column:
    last = F.greatest(F.ceil(F.octet_length(body) / size) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substr(body, i * size + 1, F.lit(size)))


def _numbered(distinct: DataFrame, name: str) -> DataFrame:
    """Distinct rows sorted within their partitions and numbered: one integer each."""
    return distinct.sortWithinPartitions(*distinct.columns).withColumn(name, F.monotonically_increasing_id())


def _block_names(body: DataFrame, size: int) -> tuple[DataFrame, int]:
    """(key, name) of each distinct block, and the seed of a key that is one-to-one over them."""
    distinct = body.select(F.explode(_blocks(F.col("body"), size)).alias("block")).distinct()
    for seed in range(KEY_SEEDS):
        names = written(
            _numbered(distinct, "name").select(F.xxhash64(F.lit(seed), "block").alias("key"), "name"), "blocks"
        )
        if names.groupBy("key").count().where("count > 1").isEmpty():
            return names, seed
    raise RuntimeError("no one-to-one block key found")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_id: str | None = None,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row_id, doc_id, text_sha256, n_blocks, name) per row; equal texts share (n_blocks, name)."""
    body = docs.select(
        (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("row_id"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )
    names, seed = _block_names(body, block_bytes)
    rows = written(
        body.select(
            "row_id",
            "doc_id",
            F.sha2("body", 256).alias("text_sha256"),
            F.transform(_blocks(F.col("body"), block_bytes), lambda b: F.xxhash64(F.lit(seed), b)).alias("keys"),
        ),
        "rows",
    )
    cells = rows.select("row_id", F.size("keys").alias("n_blocks"), F.posexplode("keys").alias("pos", "key"))
    cur = written(cells.join(names, "key").select("row_id", "n_blocks", F.col("n_blocks").alias("left_n"), "pos", "name"), "names")
    done = [cur.where("left_n = 1").select("row_id", "n_blocks", "name")]
    left = rows.agg(F.max(F.size("keys"))).first()[0] or 1
    while left > 1:
        pairs = written(
            cur.where("left_n > 1")
            .groupBy("row_id", "n_blocks", F.ceil(F.col("left_n") / 2).cast("int").alias("left_n"), F.expr("pos div 2").alias("pos"))
            .agg(F.max(F.expr("if(pos % 2 = 0, name, null)")).alias("a"),
                 F.coalesce(F.max(F.expr("if(pos % 2 = 1, name, null)")), F.lit(-1)).alias("b")),
            "pairs",
        )
        pair_names = written(_numbered(pairs.select("a", "b").distinct(), "name"), "pair-names")
        cur = written(pairs.join(pair_names, ["a", "b"]).select("row_id", "n_blocks", "left_n", "pos", "name"), "names")
        done.append(cur.where("left_n = 1").select("row_id", "n_blocks", "name"))
        left = -(-left // 2)
    named = done[0]
    for d in done[1:]:
        named = named.unionByName(d)
    return written(rows.select("row_id", "doc_id", "text_sha256").join(named, "row_id"), "identities")


def exact_duplicates(docs: DataFrame, **kw) -> DataFrame:
    """One row per input row: row_id, doc_id, keep_id, group_size, kept, text_sha256."""
    ident = identities(docs, **kw)
    groups = written(
        ident.groupBy("n_blocks", "name").agg(
            F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count(F.lit(1)).alias("group_size")
        ),
        "groups",
    )
    return ident.join(groups, ["n_blocks", "name"]).select(
        "row_id",
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("keep.row_id")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` does not keep, all columns unchanged."""
    rid = fresh(docs, "row_id")
    stamped = written(with_row_id(docs, rid), "stamped")
    found = exact_duplicates(stamped, id_col=id_col, text_col=text_col, row_id=rid)
    dropped = written(found.where(~F.col("kept")).select(F.col("row_id").alias(rid)), "dropped")
    return stamped.join(dropped, rid, "left_anti").drop(rid)


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
  count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents"""
