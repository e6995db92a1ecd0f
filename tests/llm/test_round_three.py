"""Merkle manifest, hard negatives and decontamination against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martlet.llm import decontamination, hard_negatives, manifest
from tests.llm.conftest import rows


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][k:k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def plain_path(levels, at):
    out = []
    for level in levels[:-1]:
        low = at - at % 3
        out.append(("".join(level[low:at]), "".join(level[at + 1:low + 3])))
        at //= 3
    return out


def plain_manifest(found):
    """found: (doc_id, text, source). Leaves are of these three; tampering cuts line ends of even doc_ids."""
    by_source = {}
    for i, text, source in found:
        cut = text if text is None or i is None or i % 2 else text.replace("\n", "")
        by_source.setdefault(source, []).append((i is not None, i or 0, plain_leaf((i, source, text)), plain_leaf((i, source, cut))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(by_source[s])]) for s in order}
    top = plain_tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (there, i, leaf, other) in enumerate(sorted(by_source[s])):
            path = plain_path(trees[s], at) + plain_path(top, k)
            folded = other
            for left, right in path:
                folded = digest(left, folded, right)
            out.append((i if there else None, leaf, trees[s][-1][0], top[-1][0], digest(*(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def made(df):
    return rows(manifest.manifest(df, ["doc_id", "source", "text"], tampered={"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))},
                                  where=F.col("doc_id") % 2 == 0), *MANIFEST)


def test_manifest_of_edge_rows(edge_docs, edge_rows, no_docs):
    assert made(edge_docs) == plain_manifest(edge_rows)
    assert made(no_docs) == []


def test_manifest_of_spread_ids_hot_ids_and_several_rounds(spark):
    draw = random.Random(5)
    ids = [draw.choice([k, -k, k << 40, draw.getrandbits(62), -(1 << 63), (1 << 63) - 1]) for k in range(2500)]
    found = [(i, f"a\nb{k % 900}", draw.choice(["x", "y", None])) for k, i in enumerate(ids)]
    found += [(7, f"hot {k % 60}\n", "x") for k in range(600)] + [(None, f"none {k}", "x") for k in range(300)]
    found += [(k, "dense\n", "d") for k in range(2600)] + [(k, "alone", f"s{k}") for k in range(40)]
    df = spark.createDataFrame(found, "doc_id long, text string, source string").repartition(7)
    assert made(df) == plain_manifest(found)


def test_manifest_of_a_single_row_and_bad_keys(spark):
    df = spark.createDataFrame([(4, "q\n", None)], "doc_id long, text string, source string")
    (row,) = made(df)
    assert row[1] == row[2] == row[3] and row[4] == digest() and row[5] == plain_leaf((4, None, "q")) and not row[6]
    with pytest.raises(ValueError):
        made(df.withColumn("doc_id", F.lit("4")))


def test_ranks_count_smaller_keys_with_their_weights(spark):
    draw = random.Random(2)
    keys = {(draw.choice("ab"), draw.choice([draw.randrange(-400, 400), draw.getrandbits(63), None])): draw.randrange(1, 4) for _ in range(3000)}
    df = spark.createDataFrame([(g, k, n) for (g, k), n in keys.items()], "g string, k long, n long")
    order = lambda k: (k is not None, k or 0)
    want = {(g, k): sum(n for (g2, k2), n in keys.items() if g2 == g and order(k2) < order(k)) for g, k in list(keys)[:300]}
    got = {(r["g"], r["k"]): (r["before"], r["total"]) for r in manifest.ranks(df, ["g"], "k").collect()}
    assert len(got) == len(keys)
    assert all(got[key][0] == n for key, n in want.items())
    assert all(t == sum(n for (g2, _), n in keys.items() if g2 == g) for (g, _), (_, t) in got.items())


def plain_negatives(found, anchors, positives=5, negatives=10):
    """found: (vec_id, label, v)."""
    usable = [x for x in found if x[1] is not None and x[2] is not None and all(c is not None for c in x[2])]
    out = []
    for a, (ai, al, av) in enumerate(usable):
        if ai is None or ai % anchors:
            continue
        score = [(-sum(p * q for p, q in zip(av, v)), i is None, i or 0, label, k) for k, (i, label, v) in enumerate(usable) if len(v) == len(av)]
        for ps, none, pi, _, _ in sorted(x for x in score if x[3] == al and x[4] != a)[:positives]:
            window = sorted(x for x in score if x[3] != al and 30 * -ps <= 100 * -x[0] <= 90 * -ps)[:negatives]
            out += [(ai, None if none else pi, r, None if x[1] else x[2], -ps, -x[0]) for r, x in enumerate(window, 1)]
    return sorted(out, key=repr)


NEGATIVES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(df, every, **more):
    return rows(hard_negatives.hard_negatives(df, F.col("vec_id") % every == 0, **more), *NEGATIVES)


@pytest.mark.parametrize("least", [2048, 64])
def test_hard_negatives(spark, monkeypatch, least):
    """With 64 rows to a stripe and tiles of 16 the rows of an anchor come together from many tasks."""
    monkeypatch.setattr(hard_negatives, "LEAST", least)
    monkeypatch.setattr(hard_negatives, "BLOCK", 8)
    draw = random.Random(3)
    vector = lambda: [draw.randrange(-6, 9) for _ in range(5)]
    found = [(k, draw.randrange(4), vector()) for k in range(400)]
    found += [(k, 1, [1, 2, 3, 4, 5]) for k in range(400, 520)]                                    # one hot vector, ties
    found += [(30, 2, vector()), (30, 2, vector()), (None, 1, vector()), (None, 3, [1, 2, 3, 4, 5]), (60, None, vector()), (90, 1, None),
              (120, 1, [1, None, 2, 3, 4]), (150, 0, []), (151, 1, []), (180, 2, [1, 2]), (181, 2, [3, 4]), (182, 3, [1, 2]), (0, 0, [0] * 5)]
    df = spark.createDataFrame(found, "vec_id long, label int, v array<long>").withColumn("limits", F.lit("x")).withColumn("rid", F.lit(1))
    assert mined(df.repartition(5), 30) == plain_negatives(found, 30)
    assert mined(df, 30, positives=2, negatives=3) == plain_negatives(found, 30, 2, 3)
    assert mined(df.where("1 = 0"), 30) == [] and mined(df.where("vec_id % 30 <> 0"), 30) == []


def test_scores_are_exact_beyond_doubles(spark):
    big = (1 << 30) + 1
    found = [(0, 1, [big, 1]), (1, 1, [big, 3]), (2, 2, [big // 2, 5]), (3, 2, [big // 2, 4]), (4, 2, [big, 0])]
    df = spark.createDataFrame(found, "vec_id long, label int, v array<long>")
    assert mined(df, 100) == plain_negatives(found, 100)


def test_whole_vectors(spark):
    df = spark.createDataFrame([(1, 0, [0.5, -0.001]), (2, 0, [float("nan"), 1.0]), (3, 0, None), (4, 0, [None, 1.0]), (5, 0, [float("inf"), 1.0])],
                               "vec_id long, label int, embedding array<float>")
    assert {r["vec_id"]: r["v"] for r in hard_negatives.whole_vectors(df).collect()} == {1: [128, -1], 2: None, 3: None, 4: None, 5: None}


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_contamination(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = plain_words(text)
        need = min(window, len(w))
        for k in range(len(w) - need + 1 if w else 0):
            wins.setdefault(tuple(w[k:k + need]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in wins}
    out = []
    for i, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                who = wins.get(tuple(w[k:k + n]))
                if who:
                    hit |= set(range(k, k + n))
                    found |= who
        out.append((i, len(w), len(hit), len(found), digest(",".join(sorted(found))), bool(hit)))
    return sorted(out, key=repr)


HITS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
ITEMS = "item_id long, text string, extra string"


def items_frame(spark, items):
    return spark.createDataFrame([(*x, "x") for x in items], ITEMS)


def planted(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["Ünï", "漢字", "a1", "B"]
    say = lambda n: " ".join(draw.choice(vocabulary) + draw.choice(["", "", ",", ".", "\n", "-x"]) for _ in range(n))
    items = [(k, say(draw.choice([3, 9, 10, 11, 25, 60]))) for k in range(30)]
    items += [(3, say(14)), (5, items[7][1]), (None, say(12)), (77, ""), (78, None), (79, " .,- "), (80, "w1"), (81, items[9][1].upper())]
    docs = []
    for k in range(150):
        text = say(draw.choice([0, 1, 5, 40]))
        for _ in range(draw.randrange(3)):
            w = (items[draw.randrange(30)][1]).split()
            a = draw.randrange(len(w))
            text += " " + " ".join(w[a:a + draw.randrange(1, 30)]) + " " + say(draw.randrange(5))
        docs.append((k % 140, text))
    return docs + [(None, items[0][1]), (None, items[4][1]), (900, None), (901, ""), (902, " ".join(t for _, t in docs) * 3)] * 2, items


@pytest.mark.parametrize("block_bytes, shard", [(8 << 20, 2_000_000), (300, 50)])
def test_contamination(spark, monkeypatch, block_bytes, shard):
    """Also with items in many blocks."""
    docs, items = planted(block_bytes)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, hits string").repartition(3)
    found = decontamination.contamination(df, items_frame(spark, items), block_bytes=block_bytes)
    assert rows(found, *HITS) == plain_contamination(docs, items)
    assert all(r["n_hit"] == sum(h["to"] - h["from"] for h in r["hits"]) and r["n_items"] == len(r["items"]) for r in found.collect())
    clean = Counter(r[0] for r in plain_contamination(docs, items) if not r[5])
    kept = decontamination.decontaminate(df, items_frame(spark, items), block_bytes=block_bytes)
    assert Counter(r["doc_id"] for r in kept.collect()) == clean and kept.columns == df.columns


def test_contamination_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    items = [(1, "lorem ipsum DOLOR"), (2, "the quick brown fox jumps over the lazy dog while nine sleepy cats"), (3, "漢字"), (4, "10 0 0 255")]
    docs = [(i, t) for i, t, _ in edge_rows]
    assert rows(decontamination.contamination(edge_docs, items_frame(spark, items)), *HITS) == plain_contamination(docs, items)
    none = items_frame(spark, items).where("1 = 0")
    assert rows(decontamination.contamination(edge_docs, none), *HITS) == plain_contamination(docs, [])
    assert decontamination.contamination(no_docs, items_frame(spark, items)).count() == 0
    assert decontamination.decontaminate(edge_docs, none).count() == len(docs)


def test_pieces_of_a_long_item_lose_no_window(spark, monkeypatch):
    draw = random.Random(1)
    w = [f"w{draw.randrange(500)}" for _ in range(9_000)]
    docs = [(1, " ".join(w)), (2, " ".join(w[4_090:4_106])), (3, " ".join(w[4_096:4_105])), (4, " ".join(w[8_190:8_203]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(1, " ".join(w))]
    assert rows(decontamination.contamination(df, items_frame(spark, items)), *HITS) == plain_contamination(docs, items)


def test_longest_matches(spark):
    docs, items = planted(9)
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    want, item_words = set(), [(("" if i is None else str(i)), plain_words(t)) for i, t in items]
    texts = [(i, plain_words(t)) for i, t in docs]
    for item, w in item_words:
        need = min(10, len(w))
        for q in range(len(w) - need + 1 if w else 0):
            places = []
            for i, d in texts:
                for k in range(len(d) - need + 1):
                    if d[k] != w[q] or d[k:k + need] != w[q:q + need]:
                        continue
                    n = need
                    while q + n < len(w) and k + n < len(d) and w[q + n] == d[k + n]:
                        n += 1
                    places.append((n, i, k, d))
            most = max((p[0] for p in places), default=0)
            want |= {(i, k, item, q, n) for n, i, k, d in places if n == most and (q == 0 or k == 0 or d[k - 1] != w[q - 1])}
    got = decontamination.longest_matches(df, items_frame(spark, items))
    assert {tuple(r) for r in got.collect()} == want


def test_suffix_array_is_sorted():
    import numpy as np
    draw = random.Random(4)
    runs = [[draw.randrange(1, 4) for _ in range(draw.randrange(1, 60))] for _ in range(40)] + [[1] * 50, [1] * 50]
    text = np.array([x for r in runs for x in [*r, 0]], np.int64)
    left = np.array([x for r in runs for x in [*range(len(r), 0, -1), 0]], np.int64)
    sa = decontamination.suffix_array(text, left, 60)
    suffixes = [tuple(text[k:k + left[k]]) for k in sa]
    assert suffixes == sorted(suffixes) and len(sa) == (left > 0).sum()


def test_crc_of_the_manifest_query(spark):
    got = spark.range(50).select("id", F.crc32(F.col("id").cast("string").cast("binary")).alias("c")).collect()
    assert all(r["c"] == zlib.crc32(str(r["id"]).encode()) for r in got)
