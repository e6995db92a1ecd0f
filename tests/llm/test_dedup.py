import hashlib
import random

import numpy as np
import pytest
import xxhash

from martlet.llm import embedding_dedup, passages, simhash
from martlet.llm.components import components
from martlet.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.conftest import rows


def groups(ids, links):
    """The least member of each id's component, by union and find."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(1, 1), (3, 2), (2, 3), (5, 2)]
    found = dict(rows(components(spark.createDataFrame(links, "a long, b long")), "node", "root"))
    ids = {x for link in links for x in link if link[0] != link[1]}
    assert found == groups(ids, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        text = text.replace(space, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_on_edge_rows(edge_docs, edge_rows, no_docs):
    found = simhash.near_duplicates(edge_docs)
    prints = {(i, t): plain_fingerprint(t) for i, t, _ in edge_rows}
    keys = list(prints)
    links = [(a, b) for a in range(len(keys)) for b in range(a) if (prints[keys[a]] ^ prints[keys[b]]).bit_count() <= 3]
    root = groups(range(len(keys)), links)
    least = {}
    for n, (i, _) in enumerate(keys):
        if i is not None:
            least[root[n]] = min(least.get(root[n], i), i)
    want = [(i, f"{prints[i, t]:016x}", least.get(root[keys.index((i, t))])) for i, t, _ in edge_rows]
    assert rows(found, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_fingerprints_link_up_to_three_bits_and_no_further(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(150):
        base = rng.getrandbits(64)
        prints.add(base)
        for bits in (1, 2, 3, 3, 4, 5):
            near = base
            for b in rng.sample(range(64), bits):
                near ^= 1 << b
            prints.add(near)
    hub = rng.getrandbits(64)
    prints |= {hub ^ 1 << a ^ 1 << b for a in range(12) for b in range(a)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.link_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"), 3)
    found = [(r["a"], r["b"]) for r in links.collect()]
    array = np.array(signed).view(np.uint64)
    near = [(signed[i], signed[j]) for i in range(len(signed)) for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= 3)]
    assert all((a ^ b).bit_count() <= 3 if (a ^ b) >= 0 else ((a ^ b) + (1 << 64)).bit_count() <= 3 for a, b in found)
    assert groups(signed, found) == groups(signed, near)


def test_keep_one_keeps_columns_and_the_smallest_id(edge_docs):
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None) == [1, 3, 4, 5, 5, 6, 8, 11, 12, 13]


def test_keep_one_goes_by_doc_id_and_text(spark):
    text = "the quick brown fox jumps over the lazy dog while nine sleepy cats watch from the old stone wall near the river bank"
    other = "a completely different report on harvest yields, rainfall and grain prices in the northern valleys last autumn"
    alone = "seven violins and one piano played slow music beside the frozen lake until every lamp in town went dark"
    data = [(1, text, "a"), (2, text, "b"), (2, other, "c"), (None, text, "d"), (None, alone, "e"), (None, alone, "e"),
            (None, alone, "f"), (7, "", "g"), (7, None, "h"), (7, text.upper(), "i"), (8, other.upper(), "j"), (8, other.title(), "k")]
    kept = simhash.keep_one(spark.createDataFrame(data, "doc_id long, text string, source string"))
    assert kept.columns == ["doc_id", "text", "source"]
    got = sorted((r["doc_id"] or 0, r["source"]) for r in kept.collect())
    assert [x for x in got if x[0] in (1, 2, 8)] == [(1, "a"), (2, "c")]
    assert len([x for x in got if x[0] == 0]) == 1 and got[0][1] in "ef"
    assert len([x for x in got if x[0] == 7]) == 1 and len(got) == 4
    # Equal and near-equal texts of one doc_id, which no smaller id resembles: one document stays.
    same = spark.createDataFrame([(3, text, "a"), (3, text.upper(), "b")], "doc_id long, text string, source string")
    assert simhash.keep_one(same).count() == 1


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 24))
    near = base[:40] + rng.normal(size=(40, 24)) * rng.choice([0.05, 0.3, 0.45, 0.6], size=(40, 1))
    x = np.concatenate([base, near, base[:5], base[:1] * 3])
    data = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [1.0] * 23 + [float("inf")]), (904, []),
           (905, [1.0, 0.0]), (906, [1.0, 0.0]), (907, [1.0] * 23 + [None])]
    df = spark.createDataFrame([(*r, "x", 1) for r in data + odd], "vec_id long, embedding array<float>, block string, copies int")
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    link = u @ u.T >= 0.9
    pairs = [(i, j) for i in range(len(u)) for j in range(i) if link[i, j]] + [(905, 906)]
    root = groups([r[0] for r in data + odd], pairs)
    want = [(i, sum(i in p for p in pairs), root[i], root[i] == i) for i, _ in data + odd]
    found = embedding_dedup.near_vectors(df, 0.9, block_rows=40)
    assert rows(found, "vec_id", "n_links", "component_id", "kept") == sorted(want, key=repr)
    assert embedding_dedup.near_vectors(df.where("1 = 0")).count() == 0


def test_collision_count_keeps_the_recall_at_the_threshold():
    rng = np.random.default_rng(8)
    n, d, cos = 4000, 64, 0.9
    a = rng.normal(size=(n, d))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(n, d))
    b -= (a * b).sum(1)[:, None] * a
    b = cos * a + np.sqrt(1 - cos**2) * b / np.linalg.norm(b, axis=1)[:, None]
    m = 32
    axes = np.random.default_rng(11).standard_normal((d, m))
    step = embedding_dedup.STEPS / (embedding_dedup.WINDOW * np.sqrt(2 - 2 * cos))
    qa, qb = (np.rint(v @ axes * step) for v in (a, b))
    hits = (np.abs(qa - qb) <= embedding_dedup.STEPS + 1).sum(1)
    assert (hits >= embedding_dedup.needed_collisions(m, 0.9999)).mean() > 0.998


def plain_repeats(docs, length):
    """doc -> (bytes, removed, runs, digest), by a set of all windows in order."""
    seen, out = set(), {}
    for i, text in docs:
        covered = bytearray(len(text))
        for s in range(len(text) - length + 1):
            w = text[s:s + length]
            if w in seen:
                covered[s:s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, c in zip(text, covered) if not c)
        runs = sum(c and (k == 0 or not covered[k - 1]) for k, c in enumerate(covered))
        out[i] = (len(text), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [passages.HOT, 3])
def test_passages_against_brute_force(spark, hot):
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in table(spark, SF_SMALL, "documents").orderBy("doc_id").collect()]
    found = passages.remove_repeats(table(spark, SF_SMALL, "documents"), hot=hot)
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == plain_repeats(docs, 100)


@pytest.mark.parametrize("hot", [passages.HOT, 1, 4])
def test_passages_on_edge_rows_periodic_and_binary_texts(spark, edge_rows, edge_docs, no_docs, hot):
    rng = random.Random(2)
    words = ["".join(rng.choices("abé \0", k=5)) for _ in range(12)]
    more = [(100 + k, "".join(rng.choices(words, k=rng.choice([3, 40, 200])))) for k in range(40)]
    more += [(200, "a" * 99), (201, "a" * 100), (202, "a" * 101), (203, "a" * 1500), (204, "ab" * 700), (205, "b" + "a" * 120)]
    df = spark.createDataFrame(more, "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text"))
    docs = {(i, t or "") for i, t in more} | {(i if i is not None else 2**63 - 1, t or "") for i, t, _ in edge_rows}
    want = plain_repeats([(i, t.encode()) for i, t in sorted(docs)], 100)
    found = passages.remove_repeats(df, hot=hot).collect()
    assert len(found) == len(more) + len(edge_rows)
    assert all(tuple(r)[1:] == want[r[0] if r[0] is not None else 2**63 - 1] for r in found)
    assert passages.remove_repeats(no_docs).count() == 0


def test_a_common_line_in_different_surroundings_is_split_by_window(spark):
    rng = random.Random(6)
    line = " this line of the licence stands in very many documents, each time between other words "

    def noise(n):
        return "".join(rng.choices("abcdefgh ", k=n))

    docs = [(k, noise(60) + line + (noise(60) if k % 3 else line + noise(20))) for k in range(120)] + [(k, line * 3) for k in range(120, 160)]
    found = passages.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), hot=20)
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == plain_repeats([(i, t.encode()) for i, t in docs], 100)


def test_very_long_texts_go_through_in_pieces(monkeypatch):
    text = random.Random(4).randbytes(30_000)
    whole = passages.anchor_runs([b"x", text, b""], 100)
    monkeypatch.setattr(passages, "_PIECE", 4_000)
    pieces = passages.anchor_runs([b"x", text, b""], 100)

    def windows(runs):
        return [(t, s + k, a) for t, s, w, a, _ in zip(*(x.tolist() for x in runs)) for k in range(w)]

    assert windows(whole) == windows(pieces) and len(windows(whole)) == 30_000 - 99


def test_run_length_index_names_the_first_copy():
    rng = random.Random(9)
    strings = ["".join(rng.choices("ab", k=rng.randint(6, 60))).encode() for _ in range(30)]
    index = passages.RunLengthIndex([s * 5 for s in strings], 28)
    long = [s * 5 for s in strings]
    base = np.cumsum([0, *(len(s) + 1 for s in long)])
    first = {}
    for k, s in enumerate(long):
        for at in range(len(s) - 27):
            first.setdefault(s[at:at + 28], base[k] + at)
    seen = 0
    for string, start, copy in index.first_copies(long):
        for k, s, c in zip(string.tolist(), start.tolist(), copy.tolist()):
            assert c == first[long[k][s:s + 28]]
            seen += 1
    assert seen == sum(len(s) - 27 for s in long)
