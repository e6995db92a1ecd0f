"""SimHash near-dedup by meet-in-the-middle ball hashing (operator 1).

Two fingerprints at most ``r`` bits apart have a point between them, half the
radius from either. Every fingerprint emits the variants within half the
radius, variants are shuffled, and fingerprints that meet at a variant are
verified and linked. For an odd radius one of the two goes one bit further: the
one of even parity, as a pair at an odd distance has one of either parity. Of
that outer ring only variants whose flipped bits lie in one half of the word
are needed, since more than half of an odd number of bits lie in one half.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import map_texts, materialize
from martlet.llm.components import components

BITS, HALF = 64, 32
SEED = 42
_BLOCK = 1 << 15


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of the word shingles of ``text``, as a signed 64-bit integer."""
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and \x20 \x09-\x0D.
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    line, n = b" ".join(parts), max(1, len(parts) - words + 1)
    ends = list(itertools.accumulate(len(p) + 1 for p in parts))
    first = [0, *ends]
    last = [e - 1 for e in ends[min(words, len(parts)) - 1:]]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, _BLOCK):  # bounded memory for a text of any length
        h = np.array([digest(line[a:b], SEED) for a, b in zip(first[at:min(at + _BLOCK, n)], last[at:at + _BLOCK])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) for every whole text of ``docs``."""
    return map_texts(docs, lambda ids, texts: {"doc_id": ids, "fp": [fingerprint(t, words) for t in texts]},
                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _masks(bits: range, most: int, least: int = 0) -> list[int]:
    return [sum(1 << b for b in c) for k in range(least, most + 1) for c in itertools.combinations(bits, k)]


def _flips(masks: list[int]):
    return F.array(*[F.lit(m - (1 << BITS) if m >> (BITS - 1) else m) for m in masks])


def _can_meet(fps: DataFrame, radius: int) -> DataFrame:
    """The fingerprints that have another within ``radius // 2`` bits in the upper or
    lower half. Two that are ``radius`` apart have such a half, so nothing that
    could meet is lost; the rest need not emit their balls."""
    halves = [F.shiftrightunsigned("fp", HALF), F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1)) + F.lit(1 << HALF)]
    flips = _flips(_masks(range(HALF), radius // 2))
    there = fps.select(F.explode(F.array(*halves)).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))

    def probe(half):
        return F.transform(flips, lambda m: F.struct(half.bitwiseXOR(m).alias("key"), (m == 0).alias("own")))

    probes = (fps.select("fp", F.explode(F.concat(*map(probe, halves))).alias("p")).select("fp", "p.key", "p.own"))
    # The size Spark expects of the probes is that of the rows they are made of, so it might broadcast them.
    return probes.hint("merge").join(there, "key").where("not own or n > 1").select("fp").distinct()


def _edges(batches, radius: int):
    """Links of the fingerprints that meet at a variant, from rows (v, fp) sorted by both.

    Members within half the radius of a variant are within the radius of each
    other, so linking each to the least of them links them all; a member of the
    outer ring is within the radius of every odd member inside. A variant has at
    most as many members as its ball has points, whatever the input.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    inner, none = radius // 2, np.iinfo(np.int64).max

    def links(v, fp):
        start = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
        size = np.diff(np.r_[start, len(v)])
        many = np.repeat(size > 1, size)
        if not many.any():
            return None
        v, fp, size = v[many], fp[many], size[size > 1]
        start = np.r_[0, np.cumsum(size)[:-1]]
        near = np.bitwise_count((v ^ fp).view(np.uint64)) <= inner
        odd = np.bitwise_count(fp.view(np.uint64)) % 2 == 1
        least = np.minimum.reduceat(np.where(near, fp, none), start)
        least_odd = np.minimum.reduceat(np.where(near & odd, fp, none), start)
        centre = np.where(near, np.repeat(least, size), np.repeat(least_odd, size))
        apart = np.bitwise_count((fp ^ centre).view(np.uint64))
        found = (fp != centre) & (centre != none) & (apart <= radius)
        return pa.record_batch([pa.array(fp[found]), pa.array(centre[found])], schema=schema)

    v, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        v = np.r_[v, batch.column(0).to_numpy(zero_copy_only=False)]
        fp = np.r_[fp, batch.column(1).to_numpy(zero_copy_only=False)]
        whole = int(np.searchsorted(v, v[-1])) if len(v) else 0  # the last variant may go on in the next batch
        if whole and (out := links(v[:whole], fp[:whole])) is not None:
            yield out
        v, fp = v[whole:], fp[whole:]
    if len(v) and (out := links(v, fp)) is not None:
        yield out


def link_fingerprints(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) that connect all of the distinct ``fps(fp)`` that are within ``radius`` bits."""
    inner, ring = radius // 2, radius % 2
    meet = materialize(_can_meet(fps, radius), "simhash-meet")
    balls = meet.select(F.explode(F.transform(_flips(_masks(range(BITS), inner)), lambda m: F.col("fp").bitwiseXOR(m))).alias("v"), "fp")
    if ring:
        outer = _masks(range(HALF), inner + 1, inner + 1) + _masks(range(HALF, BITS), inner + 1, inner + 1)
        balls = balls.unionByName(
            meet.where(F.bit_count("fp") % 2 == 0)
            .select(F.explode(F.transform(_flips(outer), lambda m: F.col("fp").bitwiseXOR(m))).alias("v"), "fp"))
    return (balls.repartition("v").sortWithinPartitions("v", "fp")
            .mapInArrow(lambda it: _edges(it, radius), "a bigint, b bigint").distinct())


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """Groups of near duplicates among the whole texts of ``docs(doc_id, text)``.

    Returns doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id
    reachable over links of at most ``radius`` differing bits, itself included).
    A null or empty text has fingerprint zero and is linked like any other; a null
    doc_id is returned but never names a group (a group of nulls alone has a null
    component_id); repeated rows give repeated rows; an empty table gives none;
    other columns are not read.

    Equal fingerprints are one vertex, so copies cost one row each. Text never
    leaves the task that reads it; only fingerprints are shuffled.
    """
    rows = materialize(fingerprints(docs, words), "simhash")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-fps")
    root = materialize(components(materialize(link_fingerprints(fps.select("fp"), radius), "simhash-links")), "simhash-roots")
    member = root.join(fps, root["node"] == fps["fp"]).select("node", "root", "least_id")
    least = materialize(member.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-least")
    linked = root.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    ids = materialize(fps.join(linked, "fp", "left")
                      .select("fp", F.coalesce("component_id", "least_id").alias("component_id")), "simhash-ids")
    return rows.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` without the near duplicates of a document with a smaller id, with all
    columns.

    A document is a doc_id and a text, so a row goes or stays by both: of texts
    that share a doc_id only the near duplicates go. Rows without a doc_id come
    after the others, and one of equal ones stays. A row given again with its
    doc_id and text is the same document and stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"))
    found = near_duplicates(docs.select(key.alias("doc_id"), "text"), words, radius)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    kept = docs.join(gone, key == F.col("__gone"), "left_anti")
    if found.where("doc_id.no_id").isEmpty():
        return kept
    # One of equal rows, by partial aggregates; maps can't be hashed, so they don't take part in the choice.
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    one = (kept.where("doc_id is null").groupBy(F.md5(F.col("text").cast("binary")).alias("__digest"))
           .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64(*plain)).alias("__row")))
    return kept.where("doc_id is not null").unionByName(one.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns]))
