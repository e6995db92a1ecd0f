"""Parts of operators that no SQL gives, against plain versions of their definitions."""

import bisect
import math
import random
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from martlet.llm import mixing, pii, quality, secrets, sharding
from martlet.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.test_layout import plain_targets


def xx(*parts, ints=True):
    """Spark's xxhash64 of longs, ints (given as one-element tuples), texts and nulls, unsigned."""
    h = 42
    for p in parts:
        if p is None:
            continue
        raw = p.encode() if isinstance(p, str) else struct.pack("<i", p[0]) if isinstance(p, tuple) else struct.pack("<q", p)
        h = xxhash.xxh64_intdigest(raw, h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def plain_scores(seen, rounds, least_seeds, confidence):
    score = {}
    for p, v, known in seen:
        if p is not None:
            score[p, v] = max(score.get((p, v), 0.0), float(known))
    for n in range(rounds):
        good = {}
        for p in {p for p, _ in score}:
            mine = [s for (q, _), s in score.items() if q == p]
            if sum(mine) / len(mine) >= confidence and sum(s >= confidence for s in mine) >= least_seeds:
                good[p] = sum(mine) / len(mine)
        if n == rounds - 1:
            return good
        trusted = {}
        for (p, v), s in score.items():
            if s < 1 and p in good:
                trusted[v] = max(trusted.get(v, 0.0), good[p])
        score = {(p, v): max(s, trusted.get(v, 0.0)) for (p, v), s in score.items()}


@pytest.mark.parametrize("rounds", [1, 2, 3, 4])
def test_pattern_graph(spark, rounds):
    draw = random.Random(rounds)
    share = {f"p{k}": draw.choice([0.2, 0.7, 0.85, 0.95, 1.0]) for k in range(30)}
    seen = [(p, f"v{draw.randrange(150)}", int(draw.random() < share[p])) for p in share for _ in range(draw.randrange(4, 40))] + [(None, "v1", 1)]
    df = spark.createDataFrame(seen, "pattern string, value string, known int")
    got = {r["pattern"]: r["score"] for r in pii.score_patterns(df, rounds=rounds, least_seeds=4, confidence=0.75).collect()}
    want = plain_scores(seen, rounds, 4, 0.75)
    assert got.keys() == want.keys() and want and all(got[p] == pytest.approx(want[p]) for p in want)


def plain_links(text, reach):
    """Every identifier, secret and endpoint compared with every other."""
    base = secrets.base_spans(text)
    access = [(s, e) for s, k, e in base if k == 1]
    identifiers = {*access, *((m.start(), m.end()) for m in secrets._IDENTIFIER.finditer(text))}
    hidden = {m.span(1) for m in secrets._SECRET.finditer(text) if secrets.entropy(m[1]) >= secrets.LEAST_ENTROPY} | {(s, e) for s, k, e in base if k != 1}
    hidden = {x for x in hidden if not any(s <= x[0] < e for s, e in access)}
    ends = {(m.start(), m.end()) for m in secrets._ENDPOINT.finditer(text)}
    breaks = [m.start() for m in re.finditer(r"\n[\x20\t]*\n", text)]

    def beside(a, b):
        apart = max(b[0] - a[1], a[0] - b[1])
        return 0 <= apart <= reach and bisect.bisect(breaks, a[0]) == bisect.bisect(breaks, b[0])

    found = set()
    for i in identifiers:
        partners = [s for s in hidden if beside(i, s)]
        if partners:
            found |= {(*i, "weak_id")} | {(*p, "weak_secret") for p in partners}
            found |= {(*x, "weak_endpoint") for x in ends if beside(i, x) and any(max(x[0] - p[1], p[0] - x[1]) <= 2 * reach for p in partners)}
    taken = {(s, e) for s, _, e in base}
    return sorted(x for x in found if x[:2] not in taken)


def test_links_of_credential_parts():
    draw = random.Random(12)
    run = lambda n: "".join(draw.choices("abcdefghijkLMNOP0123456789+/_=", k=n))
    parts = [lambda: f"user = u{draw.randrange(999)}x", lambda: f"AWS_ACCESS_KEY_ID={run(20)}", lambda: run(draw.choice([12, 18, 40, 300])),
             lambda: f"host: db{draw.randrange(9)}.example.org", lambda: "https://api.example.org/v1", lambda: "\n\n", lambda: "\n", lambda: " word" * draw.randrange(60),
             lambda: f"token={run(24)}", lambda: "AKIA" + "A1B2C3D4E5F6G7H8", lambda: "deadbeef" * 5, lambda: f"login='{run(6)}'"]
    linked = 0
    for _ in range(300):
        text = " ".join(draw.choice(parts)() for _ in range(draw.randrange(2, 25)))
        for reach in (40, 200):
            got = secrets.linked_parts(text, secrets.base_spans(text), reach)
            assert got == plain_links(text, reach)
            linked += len(got)
    assert linked > 1000


def plain_shard(key, leaves):
    group = [x for x in leaves if x.weight > 0]
    for level in ("region", "rack", "shard"):
        children = defaultdict(list)
        for leaf in group:
            children[getattr(leaf, level)].append(leaf)
        draws = {name: -math.log(((xx(key, level, str(name)) >> 12) + 0.5) / 2 ** 52) / sum(x.weight for x in some) for name, some in children.items()}
        group = children[min(draws, key=draws.get)]
    return group[0].shard


def test_draws_of_the_hash_tree(spark):
    ids = [None, 0, -1, *range(1, 3000, 7), 1 << 62, -(1 << 63)]
    some = sharding.topology(8)
    uneven = [sharding.Leaf(x.region, x.rack, x.shard, [0.0, 0.5, 1.0, 3.0][x.shard % 4]) for x in sharding.topology(12)]
    for leaves in (some, sharding.add_shard(some), uneven, some[:1]):
        got = spark.createDataFrame([(i,) for i in ids], "id long").select("id", sharding.shard_of(F.col("id"), leaves).alias("s")).collect()
        assert [r["s"] for r in got] == [plain_shard(r["id"], leaves) for r in got]


def plain_taken(docs, source_hash, blocks=512, seed=7):
    """docs: (doc_id, text, source). The words that the mix takes of each row."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in docs]
    mark = [xx(t, (seed + 3,)) for _, t, _ in docs]
    block = [signed(xx(i, signed(m), (seed,))) % blocks for (i, _, _), m in zip(docs, mark)]
    words, total = Counter(), Counter()
    for (_, _, s), n, b in zip(docs, size, block):
        words[s, b] += n
        total[s] += n
    goal, taken = plain_targets(dict(total)), [0] * len(docs)
    for source in total:
        passes = math.floor(goal[source] / total[source]) if total[source] else 0
        room = goal[source] - passes * total[source]
        mine = sorted({b for s, b in zip((d[2] for d in docs), block) if s == source},
                      key=lambda b: (signed(xx((b,), (source_hash[source],), (seed + 1,))), b))
        for b in mine:
            inside = [k for k, d in enumerate(docs) if d[2] == source and block[k] == b]
            inside.sort(key=lambda k: (signed(xx(docs[k][0], signed(mark[k]), (seed + 2,))), docs[k][0] is not None, docs[k][0] or 0, size[k]))
            done = 0
            for k in inside:
                more = room > 0 and (room >= words[source, b] or done + size[k] / 2 <= room)
                taken[k] = size[k] * (passes + more)
                done += size[k]
            room -= words[source, b]
    return taken


def test_words_taken_of_every_row(spark, edge_rows):
    some = [(r["doc_id"], r["text"], r["source"]) for r in table(spark, SF_SMALL, "documents").collect()]
    draw = random.Random(4)
    many = [(draw.choice([None, k, k % 9]), " w" * draw.randrange(9) + f" {k}", draw.choice("abcdefg")) for k in range(900)]
    for docs, blocks in ((some, 512), (edge_rows, 512), (many, 512), (many, 16)):
        df = spark.createDataFrame(docs, "doc_id long, text string, source string")
        hashes = {r[0]: r[1] for r in df.select("source", F.hash("source")).distinct().collect()}
        got = Counter((r["doc_id"], r["size"], r["source"], r["taken"]) for r in mixing.mix(df, blocks=blocks).collect())
        size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in docs]
        assert got == Counter((d[0], n, d[2], t) for d, n, t in zip(docs, size, plain_taken(docs, hashes, blocks)))


def plain_verdict(text, library):
    """The bands applied to figures of the library's own tokens of the whole text."""
    ids = library.encode(text)
    n = len(ids)
    counts = Counter(ids)
    chars, byte_share, entropy = float(len(text)), 0.0, 1.0
    if n >= 2:
        chars, byte_share = len(text) / n, sum(c for i, c in counts.items() if library.IsByte(i)) / n
        entropy = -sum(c / n * math.log2(c / n) for c in counts.values()) / math.log2(min(n, quality.EVEN_TOKENS))
    script = quality.script_of(text)
    short, whole = quality.BANDS[script], quality.WRITINGS[quality.writing_of(text, script)]
    part = min(1.0, n / quality.EVEN_TOKENS)
    ok = n < quality.EVEN_TOKENS or whole.bits_per_char[0] <= entropy * 8 / chars <= whole.bits_per_char[1]
    for x, name in ((chars, "chars_per_token"), (byte_share, "byte_share"), (entropy, "entropy")):
        (a, b), (c, d) = getattr(short, name), getattr(whole, name)
        low = c if part >= 1 or a == c else a + (c - a) * part
        high = d if part >= 1 or b == d else b + (d - b) * part
        ok = ok and low - 1e-9 <= x <= high + 1e-9
    return ok


def test_verdicts_of_the_bands(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = table(spark, SF_SMALL, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = quality.quality(docs, path).collect()
    assert all(r["kept"] == (not r["base_failed"] and plain_verdict(texts[r["doc_id"]], library)) for r in found)
    assert 0 < sum(r["kept"] for r in found) < len(found)
