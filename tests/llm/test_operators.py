"""The ten operators against SQL, brute force or public libraries, and on nulls, empty tables, ties,
repeated rows, clashing column names and very long texts."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ingestkit.llm import (
    bpe,
    chat,
    exact_dedup,
    graph,
    mixing,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    warc,
)
from ingestkit.llm import catalog as llm
from ingestkit.llm.common import table, written
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, row_id string, size string, ids string, n_tokens string, fp string"

LONG = " ".join(f"w{i % 977}" for i in range(40_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
HARD = [
    (1, "the same text of some words here", "a"),
    (2, "the same text of some words here", "b"),
    (2, "the same text of some words here", "b"),
    (3, None, None),
    (4, "", "a"),
    (None, "the same text of some words here", "a"),
    (None, None, None),
    (5, LONG, "b"),
    (6, LONG + " end", "b"),
    (7, f"before {PASSAGE} after", "a"),
    (8, f"other {PASSAGE} words", None),
    (9, "naïve 漢字 😀  　x\n\n\ttab </s>", "a"),
    (10, "x" * 5_000, "a"),
    (11, "a b " * 40, "b"),
]


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empty, very long, equal and repeated rows, and columns named like the operators' own."""
    rows = [(i, t, s, "r", "s", "i", "n", "f") for i, t, s in HARD]
    return written(spark.createDataFrame(rows, DOCS), "hard")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def text(row) -> str:
    return row[1] or ""


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = llm.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(llm.SQL[name])
    columns = [d[0] for d in rel.description]
    wanted = rel.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, rows)[0] == digest(columns, wanted)[0]


def test_all_operators_are_registered():
    numbers = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert numbers == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()


# 1 quality rules


def test_quality_rules_hard_rows(hard, empty):
    got = quality_rules.quality_rules(hard).collect()
    assert len(got) == len(HARD) and quality_rules.quality_rules(empty).count() == 0
    for r, h in zip(sorted(got, key=lambda r: (r.doc_id or -1, r.n_words)), sorted(HARD, key=lambda r: (r[0] or -1, len(text(r).split()))), strict=True):
        w = text(h).split(" ") if "　" not in text(h) else None
        if w is not None:
            w = [x for x in w if x]
            windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
            covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)} if len(w) < 500 else None
            assert r.n_words == len(w)
            if covered is not None:
                assert r.n_repeat_words == len(covered)
        assert not (r.base_failed and r.kept)


def test_quality_rules_follow_the_labels(spark, docs):
    got = quality_rules.quality_rules(docs).join(table(spark, SF, "labels"), "doc_id").collect()
    assert all(r.quality == int(r.kept) for r in got if not r.base_failed)


# 2 mixing


def test_targets_and_flow():
    sizes = {"a": 100, "b": 10, None: 90}
    t = mixing.targets(sizes)
    assert sum(t.values()) == 300 and all(t[s] <= 2 * n for s, n in sizes.items()) and t["b"] == 20
    got = mixing.route({("a",): 10, ("a", "b"): 10, ("b",): 4}, {"a": Fraction(18), "b": Fraction(12)})
    assert sum(got.values()) == 30 and got[("a",)] <= 20
    # repetition only once every word is used
    assert mixing.route({("a",): 10, ("b",): 10}, {"a": Fraction(7), "b": Fraction(13)}) == {("a",): 7, ("b",): 13}


def test_mixing_hard_rows(hard, empty):
    got = mixing.mixture(hard).collect()
    assert len(got) == len(HARD) and mixing.mixture(empty).count() == 0
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mixture(hard.repartition(7)).collect()), key=str)
    out = mixing.mixed_documents(hard)
    assert out.columns == hard.columns
    assert out.agg(F.sum(F.size(F.split(F.trim("text"), " +")))).first()[0] is not None


def test_mixing_takes_part_of_equal_rows(spark):
    """Copies of one id and text are split at the cut: the target is met to half a document."""
    one = written(spark.createDataFrame([(7, "a b", "s")] * 100 + [(8, "c d e", "t")] * 7, "doc_id long, text string, source string"), "copies")
    for docs in (one, one.repartition(5)):
        rows = mixing.mixture(docs).collect()
        taken, goal = defaultdict(int), {}
        for r in rows:
            taken[r.source_size] += r.taken
            goal[r.source_size] = r.target
            assert r.taken in (0, r.size, 2 * r.size)
        assert goal[200] + goal[21] == 331.5 and all(abs(taken[n] - t) <= 1.5 for n, t in goal.items())
        out = mixing.mixed_documents(docs).groupBy("doc_id").count().collect()
        assert {r.doc_id: r["count"] for r in out} == {7: taken[200] // 2, 8: taken[21] // 3}
    alone = spark.createDataFrame([(1, "a b", "s")] * 100, "doc_id long, text string, source string")
    assert sum(r.taken for r in mixing.mixture(alone).collect()) == 300


def test_mixing_more_sources_than_a_flow_takes(spark):
    n = mixing.MAX_PATTERNS + 1
    docs = spark.range(2 * n).selectExpr("id AS doc_id", f"'some words of text' AS text", f"concat('s', id % {n}) AS source")
    rows = mixing.mixture(docs)
    assert rows.count() == 2 * n
    total, want = rows.agg(F.sum("taken"), F.sum(F.col("target") / 2)).first()  # two rows a source
    assert abs(total - want) <= 2 * n and rows.where("taken > 2 * size").isEmpty()


def test_mixing_without_broadcasts(hard, monkeypatch):
    def rows():
        return sorted(map(tuple, mixing.mixture(hard).collect()), key=str), mixing.mixed_documents(hard).count()

    want = rows()
    monkeypatch.setattr(mixing, "FEW", 0)
    assert rows() == want


def test_block_numbers_are_ranks(spark):
    df = written(spark.range(1_000).selectExpr("id % 3 AS g", "id").repartition(7), "numbered")
    df = written(df.withColumn("row_id", F.monotonically_increasing_id()), "numbered-2")
    got = mixing.numbered(df, ["g"], "row_id", "rank").collect()
    for g in range(3):
        assert [r["rank"] for r in sorted((r for r in got if r.g == g), key=lambda r: r.row_id)] == list(range(1, sum(r.g == g for r in got) + 1))


# 3 chat formatting


def test_reply_paths(spark):
    rows = [(1, None, 1.0), (2, 1, 5.0), (3, 1, 1.0), (4, 3, 1.0), (5, 4, 9.0), (6, 3, 2.0), (10, 99, 0.0), (11, 10, 1.0), (12, 10, 1.0)]
    m = written(spark.createDataFrame(rows, "node long, parent long, score double"), "tree")
    best = {(1, 1), (3, 2), (4, 3), (5, 4)}
    assert {tuple(r) for r in chat.reply_paths(m).collect()} == {(5, n, d) for n, d in best} | {(11, 10, 1), (11, 11, 2)}
    assert {r.path for r in chat.reply_paths(m, 2).collect()} == {5, 2, 11, 12}
    loop = written(spark.createDataFrame([(1, 2, 0.0), (2, 1, 0.0)], "node long, parent long, score double"), "loop")
    with pytest.raises(ValueError):
        chat.reply_paths(loop)


@pytest.mark.parametrize("part_chars", [1 << 20, 40])
def test_chat_round_trip(spark, part_chars):
    marks = "</s>[INST] ok [/INST] <|turn|>\\<\\[\\ <|end|>"
    rows = [(1, 0, "user", marks, "x"), (1, 1, "assistant", marks, "x"), (1, 2, None, None, "x"), (2, 1, "assistant", "z", "x"),
            (2, 0, "us<|text|>er", "", "x"), (2, 1, "assistant", "z", "x"), (None, None, "assistant", "😀", "x")]
    rows += [(3, i, "user", f"t{i}", "x") for i in range(300)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string")
    got = chat.read_back(written(chat.formatted(chat.chains(conv), part_chars=part_chars), "chat")).collect()
    groups = defaultdict(list)
    for c, t, r, x, _ in rows:
        groups[c].append((-1 if t is None else t, r or "", x or ""))
    assert len(got) == len(groups)
    for g in got:
        turns = sorted(groups[g.conv_id])
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        assert g.n_turns == len(turns) and g.turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, r, x in turns))
        assert g.loss_chars == len(learnt) and g.loss_sha256 == sha(learnt)


def test_chat_empty(spark):
    conv = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(written(chat.formatted(chat.chains(conv)), "chat")).count() == 0


# 4 exact dedup


@pytest.mark.parametrize("block", [16_384, 7])
def test_exact_dedup_hard_rows(hard, empty, block):
    small = hard.where(F.coalesce(F.length("text"), F.lit(0)) < 6_000) if block == 7 else hard
    rows = [h for h in HARD if block != 7 or len(text(h)) < 6_000]
    got = exact_dedup.exact_duplicates(small, block_bytes=block).collect()
    groups = defaultdict(list)
    for h in rows:
        groups[sha(text(h))].append(h[0])
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
    for r in got:
        ids = [i for i in groups[r.text_sha256] if i is not None]
        assert r.group_size == len(groups[r.text_sha256]) and r.keep_id == max(ids, default=None)
        assert not r.kept or r.doc_id == r.keep_id
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_drop_duplicates_keeps_columns(hard):
    out = exact_dedup.drop_duplicates(hard)
    assert out.columns == hard.columns and out.count() == len({text(h) for h in HARD})


# 5 byte-level BPE


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    path, pattern = llm.tokenizer()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_bpe_equals_the_library(spark, hard, empty, docs, tiktoken_encoding, most):
    path, pattern = llm.tokenizer()
    for df in (hard, docs):
        rows = df.select("doc_id", "text").collect()
        tokens = bpe.encode(df, path, pattern, most=most)
        got = bpe.decode(tokens, path).collect()
        wanted = sorted((r.doc_id or -1, bpe.packed(tiktoken_encoding.encode_ordinary(r.text or ""))) for r in rows)
        assert sorted((r.doc_id or -1, bytes(r.ids)) for r in got) == wanted
        assert sorted(bytes(r.decoded) for r in got) == sorted((r.text or "").encode() for r in rows)
        assert all(r.n_tokens * 4 == len(r.ids) for r in got)
    assert bpe.encode(empty, path, pattern, most=most).count() == 0


def test_bpe_long_words(tiktoken_encoding):
    path, _ = llm.tokenizer()
    ranks = bpe.read_ranks(path)
    for w in ("a" * 3_000, "thisisalongword" * 40, "ab" * 500):
        assert bpe.merge_long(w.encode(), ranks) == tiktoken_encoding.encode_ordinary(w)


def test_bpe_rank_map_has_one_place_for_a_pair(tiktoken_encoding):
    """Any two pieces are looked up at one place; the cells of different left pieces never meet."""
    path, _ = llm.tokenizer()
    ranks = bpe.read_ranks(path)
    starts, cells = ([int(x) for x in numbers.split(",")] for numbers in bpe._literal(path)[:2])
    pairs = 0
    for piece, rank in ranks.items():
        for left, right in ((ranks.get(piece[:i]), ranks.get(piece[i:])) for i in range(1, len(piece))):
            if left is not None and right is not None:
                pairs += 1
                assert cells[starts[left] + right] == (left << 16) + rank
    assert pairs == sum(c >= 0 for c in cells)
    assert bpe._laid_over({}) == [] and bpe._laid_over({1: [3, 5], 0: [4], 2: [0, 1, 2]})


def test_bpe_fold_at_its_bounds(spark, tiktoken_encoding):
    """Equal ranks, merges at both ends and words of 63, 64 (the fold's last) and 65 bytes."""
    path, pattern = llm.tokenizer()
    words = ["a", "aaaa", "abababab", "zzzzyzzzz", "thethethe", *("x" * n + "the" * 20 for n in (3, 4, 5)), "\u6f22" * 21, "\u6f22" * 22]
    fold = bpe.Fold(path)
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.get(fold.encode(F.array("w")), F.lit(0)).alias("ids")).collect()
    for r in got:
        assert r.ids == (tiktoken_encoding.encode_ordinary(r.w) if len(r.w.encode()) <= bpe.LONG else None)


def test_bpe_plans_do_not_hold_the_rank_map(spark, hard, capsys):
    """The driver keeps the text of every plan: the map's half a million numbers stand in none."""
    path, pattern = llm.tokenizer()
    words = spark.createDataFrame([("the",), ("x" * 99,)], "w string")
    for df in (bpe.Fold(path).encoded(words, F.array("w"), "ids"), bpe.encode(hard, path, pattern)):
        capsys.readouterr()
        df.explain()
        text = capsys.readouterr().out
        assert len(text) < 20_000 and "rank_map" not in text  # nor does any row carry it


def test_bpe_long_words_are_not_sent_to_the_driver(spark, tiktoken_encoding):
    path, pattern = llm.tokenizer()
    docs = spark.createDataFrame([(i, "the the " + "x" * 99) for i in range(3)], "doc_id long, text string")
    words, ends, _ = bpe.frequent_words(docs, bpe.Fold(path), pattern, "text")
    assert sorted(words.to_pylist()) == [" the", "the"] and len(ends) == 3
    for r in bpe.encode(docs, path, pattern).collect():
        assert bytes(r.ids) == bpe.packed(tiktoken_encoding.encode_ordinary("the the " + "x" * 99))


def test_bpe_decode_rows_without_ids(spark):
    path, _ = llm.tokenizer()
    ids = bpe.packed([5, 300, 5])
    rows = [(1, None), (2, b""), (3, ids), (4, None), (5, ids + ids)]
    for some in (rows, rows[:2], []):
        df = spark.createDataFrame(some, "n int, ids binary").coalesce(1)
        got = {r.n: bytes(r.decoded) for r in bpe.decode(df, path).collect()}
        text = {0: b"", 12: b"".join(p for i in (5, 300, 5) for p, k in bpe.read_ranks(path).items() if k == i)}
        text[24] = text[12] * 2
        assert got == {n: text[len(x or b"")] for n, x in some}


def test_bpe_rows_keep_clashing_columns(hard):
    path, pattern = llm.tokenizer()
    out = bpe.encode_rows(hard, path, pattern)
    assert out.columns == [c for c in hard.columns if c != "text"] + ["_n_tokens", "_ids"] and out.count() == len(HARD)


# 6 WARC


@pytest.mark.parametrize("chunk", [1 << 20, 64])
def test_warc_round_trip(spark, chunk):
    body = "<html>" + "é" * 200 + "</html>"
    rows = [(5, "http://a/ b\r\nx", body), (3, "u", body), (4, None, body), (None, "u", body), (6, "u", "short"), (7, "u", "short"),
            (8, "u", None), (9, "u", "WARC/1.1\r\n\r\n" * 300), (3, "u", body)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    chunks = warc.read_archives(warc.write_archives(warc.record_rows(pages, chunk)), chunk)
    got = warc.pages_back(chunks).collect()
    wanted = []
    for i, _, html in rows:
        again = html == body and i != 3
        wanted.append((i, len((html or "").encode()), sha(html or ""), "revisit" if again else "response", 3 if again else None))
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    payload = b"".join(r.data for r in chunks.where("record_id = '<urn:page:9>'").orderBy("chunk_no").collect())
    assert payload == rows[7][2].encode()
    assert chunks.agg(F.max(F.octet_length("data"))).first()[0] <= chunk


def test_warc_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.pages_back(warc.read_archives(warc.write_archives(warc.record_rows(pages)))).count() == 0


# 7 sharding


def test_shards_hard_rows(hard, empty, docs):
    assert sharding.shards(empty).count() == 0
    for df, n in ((hard, 3), (docs, 24)):
        got = sharding.shards(df, n).collect()
        rows = [(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()]
        assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(i), len(b) + 8, zlib.crc32(b)) for i, b in rows)
        by = defaultdict(list)
        for r in got:
            by[r.shard].append(r)
        goal = sum(r.size for r in got) / n
        most = max(r.size for r in got)
        last = None
        for s in sorted(by):
            assert sorted(r.slot for r in by[s]) == list(range(len(by[s])))
            assert abs(sum(r.size for r in by[s]) - goal) <= most
            ids = sorted(-1 if r.doc_id is None else r.doc_id for r in by[s])
            assert last is None or last <= ids[0]
            last = ids[-1]


# 8 SimHash


def brute_components(fps: list[int], ids: list, bits: int) -> list:
    x = np.array(fps, np.uint64)
    groups = simhash.Groups(len(x))
    i, j = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= bits)
    groups.link(i, j)
    low: dict = {}
    root = groups.roots(np.arange(len(x))).tolist()
    for r, d in zip(root, ids, strict=True):
        if d is not None:
            low[r] = min(d, low.get(r, d))
    return [low.get(r) for r in root]


def test_simhash_hard_rows(hard, empty, docs):
    assert simhash.near_duplicates(empty).count() == 0
    for df in (hard, docs):
        got = simhash.near_duplicates(df).collect()
        assert len(got) == df.count()
        fps = [int(r.fingerprint, 16) for r in got]
        assert [r.component_id for r in got] == brute_components(fps, [r.doc_id for r in got], 4)
        texts = defaultdict(set)
        for r in df.collect():
            texts[r.doc_id].add(f"{simhash.fingerprint((r.text or '').encode()):016x}")
        assert all(r.fingerprint in texts[r.doc_id] for r in got)
    assert simhash.drop_near_duplicates(hard).columns == hard.columns


def test_fingerprint_counts_bits():
    import xxhash

    w = "A b c d e f a b c d".split()
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).lower(), 42) for i in range(len(w) - 3)]
    wanted = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.fingerprint(b" A b\tc d\x0be f a b c d\n") == wanted and simhash.fingerprint(None) == 0


def test_shard_tree_finds_every_pair(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    near = [base[:800] ^ (np.uint64(1) << rng.integers(0, 64, 800).astype(np.uint64)) for _ in range(4)]
    dense = base[0] ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    x = np.unique(np.concatenate([base, *near, dense]))
    fps = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    edges = simhash.links(fps, 4, shard_size=300)
    got = {r.node: r.root for r in graph.components(edges).collect()}
    root = brute_components(x.tolist(), x.view(np.int64).tolist(), 4)
    by: dict = {}
    for v, r in zip(x.view(np.int64).tolist(), root, strict=True):
        by.setdefault(r, []).append(v)
    wanted = {v: min(g) for g in by.values() if len(g) > 1 for v in g}
    assert got == wanted


def test_simhash_copies_do_not_grow_with_the_rows(spark):
    """Every fingerprint goes to one shard per block, however many shards there are."""
    rng = np.random.default_rng(8)
    for n, shard_size in ((500, 16_384), (4_000, 64), (4_000, 8)):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        depth = max(0, int(np.ceil(np.log2(len(x) / shard_size))))
        masks = simhash.blocks(4)
        assert sum(int(m) for m in masks) == 2**64 - 1 and len(masks) == 5
        for m in masks:
            shard = simhash.route(simhash.build(x[:1_000], m, depth), x, m)
            assert shard.shape == x.shape and len(set(shard.tolist())) > min(2**depth, 2) // 2
            same = {}  # shards depend on the block's bits alone
            for v, s in zip((x & m).tolist(), shard.tolist(), strict=True):
                assert same.setdefault(v, s) == s


def test_simhash_finds_all_pairs_in_a_dense_shard():
    """Thousands of fingerprints that agree in whole blocks, so that cells stay large and are parted by levels."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    flips = np.array([[1 << b for b in rng.integers(0, 64, 6)] for _ in range(3_000)], np.uint64)
    x = np.unique(base[rng.integers(12, size=3_000)] ^ np.bitwise_xor.reduce(flips, 1))
    want = simhash.Groups(len(x))
    for i in range(len(x)):
        j = np.flatnonzero(np.bitwise_count(x[i] ^ x) <= 4)
        want.link(np.full(len(j), i), j)
    got = simhash.Groups(len(x))
    for m in simhash.blocks(4):
        root = simhash.shard_roots(x, m, 4)
        got.link(np.arange(len(x)), root)
    every = np.arange(len(x))
    assert (got.roots(every) == want.roots(every)).all()


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1400)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(101)} | {i: 1000 for i in range(1000, 1400)}


# 9 quality classifier


def test_classifier_on_held_out_rows(spark, empty):
    d = "/root/testdata/sf0.01"
    labels = table(spark, d, "labels")
    got = quality_classifier.classify(table(spark, d, "documents"), labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert min(r.score for r in held if r.quality) > np.median([r.score for r in held if not r.quality])
    assert quality_classifier.classify(empty, labels).count() == 0


def test_classifier_does_not_learn_from_held_out_labels(spark):
    d = SF
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    wrong = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted(map(tuple, quality_classifier.classify(docs, x).collect())) for x in (labels, wrong))
    assert one == two


def test_classifier_hard_rows(spark, hard):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_classifier.classify(hard, labels).collect()
    assert len(got) == len(HARD) and all(0 <= r.score <= 1 for r in got)
    none = quality_classifier.classify(hard, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_classifier.accepted(hard, labels).columns == hard.columns


def test_features_of_long_texts_cover_the_whole_text():
    place = np.empty(quality_classifier.FEATURES, np.int64)
    text_ = (LONG * 8).encode()
    assert len(text_) > quality_classifier.CHUNK
    whole = set(quality_classifier.features(text_, place).tolist())
    parts = {x for i in range(0, len(text_) - 3, 50_000) for x in quality_classifier.features(text_[i : i + 50_003], place).tolist()}
    assert whole >= {x for x in parts if x < 1 << quality_classifier.BITS}


# 10 substring dedup


def brute_repeats(rows: list[tuple], length: int) -> list[tuple]:
    first: dict = {}
    for i, t, *_ in rows:
        w = (t or "").split()
        for a in range(len(w) - length + 1):
            k = tuple(w[a : a + length])
            first[k] = min(first.get(k, 1 << 63), (1 << 63) - 1 if i is None else i)
    out = []
    for i, t, *_ in rows:
        w, gone = (t or "").split(), set()
        for a in range(len(w) - length + 1):
            if first[tuple(w[a : a + length])] < ((1 << 63) - 1 if i is None else i):
                gone.update(range(a, a + length))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=str)


def test_substring_dedup_hard_rows(spark, hard, empty):
    assert substring_dedup.remove_repeats(empty).count() == 0
    rows = [h for h in HARD if "　" not in text(h)]
    got = substring_dedup.remove_repeats(hard.where("doc_id is null or doc_id <> 9")).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows, 50)


def test_substring_dedup_random_texts(spark):
    rng = np.random.default_rng(5)
    for length, gram, words in ((6, 2, 3), (12, 4, 2)):
        rows = [(int(i) if i else None, " ".join(f"v{x}" for x in rng.integers(0, words, rng.integers(0, 90)))) for i in rng.integers(0, 30, 60)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = substring_dedup.remove_repeats(df, length, gram).drop("kept").collect()
        assert sorted(map(tuple, got), key=str) == brute_repeats(rows, length)


# pipeline


def test_pipeline_against_brute_force(spark, tiktoken_encoding):
    import corpus_pipeline as cp

    docs = table(spark, SF, "documents")
    kept = []
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF), name)
        kept.append(docs.collect())
    classified, exact, near, mixed, tokens = kept
    good = {r.doc_id for r in llm.op9_quality_classifier(spark, SF).where("predicted = 1").collect()}
    assert {r.doc_id for r in classified} == good
    last = {r.text or "": r.doc_id for r in sorted(classified, key=lambda r: r.doc_id)}
    assert {r.doc_id for r in exact} == set(last.values())
    fps = [simhash.fingerprint((r.text or "").encode()) for r in exact]
    assert {r.doc_id for r in near} == set(brute_components(fps, [r.doc_id for r in exact], 4))
    size = {r.doc_id: len((r.text or "").split()) for r in near}
    times = defaultdict(int)
    for r in mixed:
        times[r.doc_id] += 1
    assert set(times) <= set(size) and max(times.values()) <= 2 and all(size[i] for i in times)
    goal, taken = mixing.targets(_sizes(near)), defaultdict(int)
    for r in mixed:
        taken[r.source] += size[r.doc_id]
    assert all(abs(taken[s] - goal[s]) <= max(size.values()) for s in goal)
    wanted = sorted((r.doc_id, bpe.packed(tiktoken_encoding.encode_ordinary(r.text or ""))) for r in mixed)
    assert sorted((r.doc_id, bytes(r.ids)) for r in tokens) == wanted


def test_token_stage_has_one_python_step_at_a_time(spark):
    """Ids are written before they are decoded, so that a task holds fewer worker processes; rows and digests stay."""
    import corpus_pipeline as cp

    rows = [(1, None), (2, ""), (None, "a b a"), (4, "the thing"), (4, "the thing")]
    out = cp.token_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    wanted = sorted((i or -1, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((r.doc_id or -1, r.decoded_sha256) for r in out.collect()) == wanted


def test_relieve_collects_where_tasks_run(spark):
    from ingestkit.llm.common import relieve

    def collections() -> int:
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return max(b.getCollectionCount() for b in beans if "Young" not in b.getName() and "Concurrent" not in b.getName() and b.getName() != "Copy")

    before = collections()
    relieve(spark)
    assert collections() >= before + 2  # the driver's, and at least one of the tasks'


def _sizes(rows) -> dict:
    out: dict = defaultdict(int)
    for r in rows:
        out[r.source] += len((r.text or "").split())
    return dict(out)


def test_batches_of_a_task_are_bounded():
    """op10: rows are worked on by slices, and windows are handed over in batches of many documents' rows."""
    import numpy as np
    import pyarrow as pa

    from ingestkit.llm import substring_dedup as sd

    n = 3 * sd.SLICE_ROWS + 7
    sizes = [b.num_rows for b in sd._sliced(iter([pa.RecordBatch.from_arrays([pa.array(range(n))], ["x"])]))]
    assert sum(sizes) == n and max(sizes) == sd.SLICE_ROWS
    parts = [(np.arange(i * 10_000, (i + 1) * 10_000),) for i in range(10)]
    out = list(sd._batches(parts, ["x"]))
    assert max(b.num_rows for b in out) == sd.WINDOW_ROWS and pa.Table.from_batches(out)["x"].to_pylist() == list(range(100_000))
