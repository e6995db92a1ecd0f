import re
import zlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from martlet.llm import bpe, mixing, pii, quality, sharding, simhash
from martlet.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.conftest import rows


def test_sharding_on_edge_rows(edge_docs, edge_rows, no_docs):
    found = sharding.place(edge_docs).collect()
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in edge_rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr) == want
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    by_key = {}
    for r in found:
        assert by_key.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
    assert sharding.place(no_docs).count() == 0


def test_a_new_shard_only_takes_rows_and_shards_share_by_weight(spark):
    keys = spark.range(40_000)
    leaves = sharding.topology(8)
    grown = sharding.add_shard(leaves)
    moved = keys.select(sharding.shard_of(F.col("id"), leaves).alias("a"), sharding.shard_of(F.col("id"), grown).alias("b")).collect()
    assert {r["b"] for r in moved if r["a"] != r["b"]} == {8}
    counts = Counter(r["a"] for r in moved)
    assert all(4_600 < counts[s] < 5_400 for s in range(8))
    assert 4_100 < sum(r["b"] == 8 for r in moved) < 4_800


def test_movement_stays_in_the_subtree_whose_weight_changes(spark):
    leaves = sharding.topology(8)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 1 else 1.0) for x in leaves]
    moved = spark.range(20_000).select(sharding.shard_of(F.col("id"), leaves).alias("a"), sharding.shard_of(F.col("id"), heavier).alias("b")).where("a <> b").collect()
    assert moved and all(r["b"] in (0, 1, 2, 3) for r in moved)  # region 0 gained weight; rows move only into it or within it
    assert not [r for r in moved if r["a"] == 1]
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit(1), [])


def plain_targets(sizes):
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, still, out = float(sum(sizes.values())), list(order), {}
    while still:
        share = {s: left * weight[s] / sum(weight[x] for x in still) for s in still}
        over = [s for s in still if share[s] > 3 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            still.remove(s)
    return out


def test_targets_of_many_sources_need_no_window_over_all(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_CHUNK", 16)
    sizes = {f"s{k:03}": (k * 37) % 101 for k in range(300)} | {None: 9}
    found = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    got = {r["source"]: r["target"] for r in found.collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], rel=1e-9) for s in want)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1000, None: 5}, {"z": 0, "é": 7, "Z": 900}, {None: 3}, {f"s{k}": k * k for k in range(40)}])
def test_targets_equal_sharing_round_by_round(spark, sizes):
    found = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    want = plain_targets(sizes)
    got = {r["source"]: r["target"] for r in found.collect()}
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], rel=1e-9) for s in want)


def test_mix_takes_what_the_targets_say(spark, edge_docs, no_docs):
    for docs in (table(spark, SF_SMALL, "documents"), edge_docs):
        found = mixing.mix(docs).collect()
        plain = [(r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")), r["source"]) for r in docs.collect()]
        assert sorted(((r["doc_id"], r["size"], r["source"]) for r in found), key=repr) == sorted(plain, key=repr)
        sizes = Counter()
        for _, size, source in plain:
            sizes[source] += size
        want = plain_targets(dict(sizes))
        for source in sizes:
            mine = [r for r in found if r["source"] == source]
            assert all(r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source]) for r in mine)
            assert abs(sum(r["taken"] for r in mine) - want[source]) <= max(r["size"] for r in mine)
        assert all(r["taken"] == r["size"] * r["copies"] and r["copies"] <= 3 and len(r["shards"]) == r["copies"] for r in found)
        assert rows(mixing.mix(docs.repartition(5)), "doc_id", "taken", "shards") == sorted(
            ((r["doc_id"], r["taken"], r["shards"]) for r in found), key=repr)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_hypergeometric_tree_adds_up_and_follows_its_law(spark):
    quotas = spark.createDataFrame([(f"s{k}", 40) for k in range(400)], "source string, quota long")
    found = mixing.shard_quotas(quotas, 8, F.lit(10).cast("long"), 3).collect()
    per_source = Counter()
    for r in found:
        assert 0 <= r["quota"] <= 10
        per_source[r["source"]] += r["quota"]
    assert set(per_source.values()) == {40} and len(found) == 3200
    spread = sum((r["quota"] - 5) ** 2 for r in found) / len(found)
    assert 1.9 < spread < 2.6  # 40 of 80 slots, 10 in a shard: variance 10 * 1/2 * 1/2 * 70/79 = 2.2


def test_mixed_documents_repeat_whole_rows(spark):
    docs = table(spark, SF_SMALL, "documents")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == copies


def test_pipeline_stages_do_their_work_on_what_came_before(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF_SMALL)
        assert docs.columns == before.columns
        kept[name] = (before, docs)
    before, after = kept["quality rules"]
    good = {r["doc_id"] for r in quality.quality(before, public_tokenizers.path("piece_bpe_32k.model")).where("kept").collect()}
    assert {r["doc_id"] for r in after.collect()} == good
    before, after = kept["near dedup"]
    assert {r["doc_id"] for r in after.collect()} == {r["component_id"] for r in simhash.near_duplicates(before).collect()}
    before, after = kept["personal data"]
    assert before.count() == after.count()
    assert pii.find_pii(after).agg(F.sum(F.expr("n_email + n_ip + n_card + n_phone"))).first()[0] == 0
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        codec = bpe.BytePairCodec(f.read())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(encoded) == docs.count() and all(codec.decode(r["ids"]) == texts[r["doc_id"]] for r in encoded)


def test_run_equals_the_stages_and_is_registered(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    docs = table(spark, SF_SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert rows(out, "doc_id", "ids_sha256") == rows(docs, "doc_id", "ids_sha256")
    assert sum(bool(re.match(r"op\d+_", q)) for q in entry.queries()) == 13


def test_stages_of_an_empty_table_keep_it_empty(spark, no_docs):
    docs = no_docs
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_SMALL)
        assert docs.count() == 0 and (docs.columns == before.columns or name == "bpe encoding")


def test_stages_on_edge_rows(spark, edge_docs, edge_rows):
    docs, passage = edge_docs, edge_rows[4][1]
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        kept.append(Counter((r["doc_id"], r["source"]) for r in docs.collect()))
    given = Counter((i, s) for i, _, s in edge_rows)
    # Texts of fewer than ten words and those that repeat one line go; so do later copies of a passage; rows keep their columns.
    assert {i for i, _ in kept[0]} == {5, 7, None} and not kept[0] - given
    assert {i for i, _ in kept[1]} <= {5, None} and kept[1][(5, "b")] >= 1 and not kept[1] - kept[0]
    assert kept[2] == kept[1]
    assert set(kept[3]) <= set(kept[2])
    masked = [r["text"] for r in corpus_pipeline.personal_data(spark, edge_docs, SF_SMALL).where("doc_id = 12").collect()]
    assert len(masked) == 1 and "bob.x@" not in masked[0] and "10.0.0.256" in masked[0]
    encoded = corpus_pipeline.bpe_encoding(spark, docs, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in encoded) == Counter(r["doc_id"] for r in docs.collect()) and passage


