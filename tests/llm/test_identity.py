"""Rows that share an id, or have none, are rows of their own."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import embedding_dedup, mixing, passages, sharding
from tests.llm.conftest import rows
from tests.llm.test_dedup import groups
from tests.llm.test_layout import plain_targets


def test_vectors_that_share_a_vec_id_are_vertices_of_their_own(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 16))
    x = np.r_[base, base[:20] + rng.normal(size=(20, 16)) * 0.1, base[:6]]
    ids = [None if k % 5 == 4 else k % 12 for k in range(len(x))]                  # each id names several vectors
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    link = u @ u.T >= 0.9
    pairs = [(i, j) for i in range(len(u)) for j in range(i) if link[i, j]]
    root = groups(range(len(u)), pairs)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    want = [(i, sum(k in p for p in pairs), least.get(root[k]), i == least.get(root[k])) for k, i in enumerate(ids)]
    found = embedding_dedup.near_vectors(df, 0.9, block_rows=16)
    assert rows(found, "vec_id", "n_links", "component_id", "kept") == sorted(want, key=repr)


def test_an_orthogonal_vector_of_the_same_id_links_with_nothing(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01])], "vec_id long, embedding array<float>")
    found = embedding_dedup.near_vectors(df, 0.9)
    assert rows(found, "vec_id", "n_links", "component_id") == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]


@pytest.mark.parametrize("chunk", [4096, 7])
def test_slots_of_hot_ids_and_of_equal_rows(spark, chunk):
    data = [(None, f"none {k}") for k in range(900)] + [(5, "same")] * 700 + [(k, None if k % 9 else "t") for k in range(600)] + [(None, None)] * 50
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    found = sharding.place(df, chunk=chunk, cells=16).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data), key=repr)
    for shard in range(8):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    by_key = {}
    assert all(by_key.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"]) for r in found)


def test_hot_ids_do_not_fill_a_task_of_the_numbering(spark):
    """A third of the rows without an id: the cells that are numbered stay even."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"))
    placed = sharding.place(df, cells=64)
    hot = placed.where("doc_id is null").select("shard").first()[0]
    mine = [r["slot"] for r in placed.where(f"shard = {hot}").collect()]
    cells = df.where("doc_id is null").select(F.pmod(F.xxhash64(
        "doc_id", F.crc32(F.col("text").cast("binary")), F.octet_length("text").cast("long") + 1, F.lit("cell")), F.lit(64)).alias("c")).groupBy("c").count()
    assert sorted(mine) == list(range(len(mine))) and cells.count() == 64 and cells.agg(F.max("count")).first()[0] < 3 * 10_000 / 64


@pytest.mark.parametrize("ids", ["id % 5", "if(id % 3 = 0, null, id)", "cast(null as bigint)"])
def test_mixed_documents_meet_the_targets_whatever_ids_are_shared(spark, ids):
    docs = spark.range(600).selectExpr(f"{ids} as doc_id", "substr('abc', cast(id % 3 as int) + 1, 1) as source",
                                       "concat('w', id, repeat(' x', cast(id % 7 as int)), ' tail') as text", "id as other")
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, most = Counter(), 9
    for r in docs.collect():
        sizes[r["source"]] += size(r["text"])
    mixed = mixing.mixed_documents(docs)
    got, times = Counter(), Counter()
    for r in mixed.collect():
        got[r["source"]] += size(r["text"])
        times[r["other"]] += 1
    want = plain_targets(dict(sizes))
    assert mixed.columns == docs.columns and all(abs(got[s] - want[s]) <= most for s in sizes)
    assert max(times.values()) <= 3
    assert Counter(r["copies"] for r in mixing.mix(docs).collect() if r["copies"]) == Counter(times.values())
    again = mixing.mixed_documents(docs.repartition(7))
    assert Counter(r["other"] for r in again.collect()) == times


def test_equal_rows_are_taken_as_often_as_the_mix_says(spark):
    docs = spark.range(900).selectExpr("id % 3 as doc_id", "if(id % 4 = 0, null, 'a') as source", "concat('w ', id % 5) as text", "'x' as other")
    mixed = Counter(tuple(r) for r in mixing.mixed_documents(docs).collect())
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"], r["source"]] += r["copies"]
    got = Counter()
    for (i, source, _, _), n in mixed.items():
        got[i, source] += n
    assert got == +want and sum(got.values())


def test_blocks_of_a_hot_id_are_even(spark):
    docs = spark.range(6000).selectExpr("if(id % 3 = 0, null, id) as doc_id", "'a' as source", "concat('w', id) as text")
    words = docs.where("doc_id is null").select(F.pmod(F.xxhash64("doc_id", F.xxhash64("text", F.lit(10)), F.lit(7)), F.lit(512)).alias("b")).groupBy("b").count()
    assert words.count() > 400 and words.agg(F.max("count")).first()[0] < 30
    assert mixing.mix(docs).agg(F.sum("taken"), F.first("target")).first()[0] == 18_000 // 3 * 1


@pytest.mark.parametrize("hot", [passages.HOT, 4])
def test_passages_of_many_rows_under_one_id(spark, hot):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    lines = [noise(130) for _ in range(12)]
    data = [(rng.choice([None, None, 3, 4, 5]), noise(rng.randrange(150)) + rng.choice(lines) + noise(rng.randrange(80))) for _ in range(150)]
    data += [(3, data[0][1]), (None, data[1][1]), (9, data[2][1])]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    mark = {r["text"]: r["m"] for r in df.select("text", F.xxhash64(F.col("text").cast("binary")).alias("m")).collect()}
    # Earlier: the smaller id, null last, then the smaller hash of the text; rows equal in both are one document.
    order = sorted({(2 ** 63 - 1 if i is None else i, mark[t], t) for i, t in data})
    seen, want = set(), {}
    for i, _, t in order:
        raw, covered = t.encode(), bytearray(len(t))
        for s in range(len(raw) - 99):
            if raw[s:s + 100] in seen:
                covered[s:s + 100] = b"\1" * 100
            seen.add(raw[s:s + 100])
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        want[i, t] = (len(raw), sum(covered), hashlib.sha256(kept).hexdigest())
    found = rows(passages.remove_repeats(df, hot=hot), "doc_id", "n_bytes", "n_removed", "kept_sha256")
    assert found == sorted(((i, *want[2 ** 63 - 1 if i is None else i, t]) for i, t in data), key=repr)


def test_passages_need_whole_numbers_as_ids(spark):
    with pytest.raises(ValueError, match="whole numbers"):
        passages.remove_repeats(spark.createDataFrame([("a", "x")], "doc_id string, text string"))
