"""Repeated passages by a run-compressed Burrows-Wheeler index (operator 10).

1. Every window of ``length`` bytes has an anchor: the least hash of the
   32-byte strings in it. Equal windows have equal anchors, so a window whose
   anchor occurs in no other run of windows occurs once. Anchors (two numbers
   per run, about one run in 35 bytes) are shuffled and counted.
2. Runs of windows whose anchor is repeated are cut out, gathered by anchor and
   joined into texts of about ``BATCH`` bytes: all copies of a window meet in one.
3. Such a text gets a run-length Burrows-Wheeler index: run heads and starts,
   counts up to each run, and where a run of equal contexts starts, the sampled
   place of its first copy. The cut-out strings are streamed through it from
   right to left; each step extends the match by one byte and cuts it back to
   ``length``, which names the window's context and so the first copy.
4. Windows whose first copy is elsewhere are covered; per document the covered
   bytes are removed from the text.

An anchor with very many copies is hot and would be one large group. Of its strings
each different one is kept once, with its first place, and the places of the copies
are joined to that; different strings are indexed by anchor as before, and where
these too are very many they are split by window.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from martlet.llm.common import materialize
from martlet.session import scratch

GRAM = 32
#: Bytes of text that are hashed at a time, held back for local counts, and indexed together.
CHUNK, HELD, BATCH = 1 << 19, 1 << 24, 1 << 20
#: Slots that tell which doc_ids several rows share.
_SLOTS = 1 << 20
#: Windows of a string that are streamed one after the other.
STREAMED = 512
#: Copies of an anchor, or different strings of it, that one group holds. Beyond it, and
#: beyond this share of the copies of all such anchors, an anchor is hot: there are fewer
#: than a million of them, whatever the input.
HOT, HOT_SHARE = 4096, 1e-6
_MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


#: The least hash and the leftmost place of it are found together: a place needs this many bits.
_PLACE_BITS = 24
_PIECE = 1 << 22


def _pieces(texts: list[bytes], length: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The texts, very long ones in pieces that overlap by a window less one byte; whose and where each is."""
    whose = np.arange(len(texts))
    if max(map(len, texts), default=0) <= _PIECE:
        return texts, whose, np.zeros(len(texts), np.int64)
    cuts = [(k, at) for k, t in enumerate(texts) for at in range(0, max(1, len(t) - length + 1), _PIECE)]
    whose, at = np.array(cuts).T
    return [texts[k][a:a + _PIECE + length - 1] for k, a in cuts], whose, at


def anchor_runs(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor, recurs) of the maximal runs of windows with one
    anchor. A run recurs if its anchor is in it at several places, so that a window
    of it may occur twice in it. A very long text goes through in pieces."""
    pieces, whose, at = _pieces(texts, length)
    found, first, size = [], 0, 0
    for k, piece in enumerate(pieces):
        size += len(piece)
        if size >= CHUNK or k == len(pieces) - 1:
            text, *rest = _anchors(pieces[first:k + 1], length)
            found.append((text + first, *rest))
            first, size = k + 1, 0
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    text, start, windows, anchor, recurs = (np.concatenate(x) for x in zip(*found))
    return whose[text], start + at[text], windows, anchor, recurs.astype(bool)


def _anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.r_[0, np.cumsum(sizes)[:-1]]
    buf, n = b"".join(texts), int(sizes.sum())
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    eight = np.ascontiguousarray(np.ndarray((n - 7,), "<u8", buf, strides=(1,)))
    grams = n - GRAM + 1
    h = np.zeros(grams, np.uint64)
    for k, m in enumerate(_MULTIPLIERS):
        h += eight[8 * k:8 * k + grams]
        h *= m
        h ^= h >> np.uint64(29)
    least = h >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)
    least |= np.arange(grams, dtype=np.uint64)
    width, span = 1, length - GRAM + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    place = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    moved = np.flatnonzero(place[1:] != place[:-1]) + 1  # windows whose anchor is at another place than before
    same = h[place[moved]] == h[place[moved - 1]]
    cuts = np.union1d(moved[~same], offsets[sizes >= length])
    text = np.searchsorted(offsets, cuts, "right") - 1
    windows = np.minimum(np.r_[cuts[1:], n], offsets[text] + sizes[text] - length + 1) - cuts
    recurs = np.zeros(len(cuts), bool)
    recurs[np.searchsorted(cuts, moved[same], "right") - 1] = True
    ok = windows > 0
    cuts, text, windows, recurs = cuts[ok], text[ok], windows[ok], recurs[ok]
    return text, cuts - offsets[text], windows, h[place[cuts]].view(np.int64), recurs


def _chunks(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[list]:
    """Rows (as tuples of Python values) in lists that hold about ``size`` bytes of a column."""
    rows, held = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns]):
                rows.append(row)
                held += len(row[column])
                if held >= size:
                    yield rows
                    rows, held = [], 0
    if rows:
        yield rows


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[starts, len(values)].astype(np.int32)), pa.array(values))


_LIST = pa.list_(pa.int64())
_PARTS = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("anchors", _LIST), ("docs", _LIST)])
#: An anchor met once in a task (with its document); one met again (with the number of
#: copies in place of the document); the documents of one met again, for which that settles it.
_ONCE, _AGAIN, _SETTLED = range(3)


def _anchor_parts(batches, length: int, parts: int):
    """Anchors of the rows (own, text), counted within the task and dealt over ``parts``."""

    def rows(kind, part, anchors, docs):
        order = np.argsort(part, kind="stable")
        part, anchors, docs = part[order], anchors[order], docs[order]
        start = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][:len(part)])
        return pa.record_batch([pa.array(part[start].astype(np.int32)), pa.array(np.full(len(start), kind, np.int32)),
                                _lists(anchors, start), _lists(docs, start)], schema=_PARTS)

    def dealt(held):
        anchors, docs = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((docs, anchors))
        anchors, docs = anchors[order], docs[order]
        first = np.r_[True, anchors[1:] != anchors[:-1]][:len(anchors)]
        start = np.flatnonzero(first)
        copies = np.diff(np.r_[start, len(anchors)])
        again = np.repeat(copies > 1, copies)
        part = (anchors.view(np.uint64) % np.uint64(parts)).astype(np.int64)
        yield rows(_ONCE, part[~again], anchors[~again], docs[~again])
        yield rows(_AGAIN, part[again & first], anchors[again & first], copies[copies > 1])
        told = again & np.r_[True, (anchors[1:] != anchors[:-1]) | (docs[1:] != docs[:-1])][:len(anchors)]
        yield rows(_SETTLED, docs[told] % parts, anchors[told], docs[told])

    held, size = [], 0
    for chunk in _chunks(batches, 1, CHUNK):
        docs, texts = np.array([r[0] for r in chunk], np.int64), [r[1] for r in chunk]
        text, _, _, anchor, recurs = anchor_runs(texts, length)
        whole = np.r_[np.arange(len(text)), np.flatnonzero(recurs)]  # one that recurs counts twice
        held.append((anchor[whole], docs[text[whole]]))
        size += sum(map(len, texts))
        if size >= HELD:
            yield from dealt(held)
            held, size = [], 0
    if held:
        yield from dealt(held)


_GROUPS = pa.schema([("group", pa.int32()), ("anchors", _LIST), ("docs", _LIST), ("counted", pa.bool_())])


def _repeated(batches, groups: int, hot: int):
    """The repeated anchors and their documents, by group of documents, from all rows of some
    parts; and, counted, anchors of more than ``hot`` copies with their number."""

    def rows(group, anchors, docs, counted):
        order = np.argsort(group, kind="stable")
        anchors, docs, group = anchors[order], docs[order], group[order]
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][:len(group)])
        return pa.record_batch([pa.array(group[start].astype(np.int32)), _lists(anchors, start), _lists(docs, start),
                                pa.array(np.full(len(start), counted))], schema=_GROUPS)

    lists = {kind: ([], []) for kind in (_ONCE, _AGAIN, _SETTLED)}
    for batch in batches:
        kinds = batch.column(1).to_numpy()
        for at, kind in enumerate(kinds):
            for to, column in zip(lists[kind], (2, 3)):
                to.append(batch.column(column)[at].values.to_numpy())
    none = np.zeros(0, np.int64)
    (once, once_docs), (again, copies), (anchors, docs) = ([np.concatenate([none, *x]) for x in lists[k]] for k in (_ONCE, _AGAIN, _SETTLED))
    values, place = np.unique(np.r_[once, again], return_inverse=True)
    counts = np.zeros(len(values), np.int64)
    np.add.at(counts, place, np.r_[np.ones(len(once), np.int64), copies])
    twice = (counts > 1)[place[:len(once)]]
    anchors, docs = np.r_[anchors, once[twice]], np.r_[docs, once_docs[twice]]
    yield rows(docs % groups, anchors, docs, False)
    many = counts > hot
    yield rows(values[many] % groups, values[many], counts[many], True)


_WANTED = pa.schema([("own", pa.int64()), ("anchors", _LIST), ("copies", _LIST)])


def _by_document(batches):
    """One row (doc, anchors) per document, from all rows of some groups, and one row
    without a document that holds the counted anchors and their copies."""
    none = np.zeros(0, np.int64)
    parts = {False: [[none], [none]], True: [[none], [none]]}
    for batch in batches:
        for counted, lists in parts.items():
            some = batch.filter(pc.equal(batch.column(3), counted))
            for to, column in zip(lists, (1, 2)):
                to.append(some.column(column).flatten().to_numpy())
    anchors, docs = map(np.concatenate, parts[False])
    order = np.lexsort((anchors, docs))
    anchors, docs = anchors[order], docs[order]
    start = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]][:len(docs)])
    yield pa.record_batch([pa.array(docs[start]), _lists(anchors, start), pa.nulls(len(start), _LIST)], schema=_WANTED)
    anchors, copies = map(np.concatenate, parts[True])
    if len(anchors):
        one = np.zeros(1, np.int64)
        yield pa.record_batch([pa.nulls(1, pa.int64()), _lists(anchors, one), _lists(copies, one)], schema=_WANTED)


_CUT = pa.schema([("anchor", pa.int64()), ("bytes", pa.binary()), ("recurs", pa.bool_()), ("places", pa.binary())])
_PLACE = np.dtype([("doc", "<i8"), ("mark", "<i8"), ("start", "<i8")])


def _packed(batches):
    """Rows (doc_id, doc, mark, own, text) with the text compressed, for the shuffles it takes part in."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = pa.array([pack(t) for t in part.column(4).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:4], texts], names=["doc_id", "doc", "mark", "own", "packed"])


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _cut_out(batches, length: int, hot: np.ndarray):
    """Runs of windows with a repeated anchor that is not ``hot``, from rows (doc, mark, packed
    text, its repeated anchors). Equal ones of a task become one row with their places."""
    found: dict[tuple[int, bytes, bool], array] = {}

    def rows():
        keys, places = list(found), [x.tobytes() for x in found.values()]
        return pa.record_batch([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.binary()),
                                pa.array([k[2] for k in keys], pa.bool_()), pa.array(places, pa.binary())], schema=_CUT)

    size = 0
    for chunk in _chunks(batches, 2, CHUNK // 2):
        texts = [_unpack(r[2]) for r in chunk]
        text, start, windows, anchor, recurs = anchor_runs(texts, length)
        wanted = np.unique(np.array([a for r in chunk for a in r[3]], np.int64))
        keep = np.isin(anchor, wanted) & ~np.isin(anchor, hot)
        for t, s, w, a, r in zip(*(x[keep].tolist() for x in (text, start, windows, anchor, recurs))):
            cut = texts[t][s:s + w + length - 1]
            if (places := found.get((a, cut, r))) is None:
                places = found[a, cut, r] = array("q")
                size += len(cut)
            size += 24
            places.extend((chunk[t][0], chunk[t][1], s))
        if size >= HELD:
            yield rows()
            found, size = {}, 0
    if found:
        yield rows()


_FIRST = [("first_doc", pa.int64()), ("first_mark", pa.int64()), ("first_start", pa.int64())]
_KEYED = pa.schema([("id", pa.binary()), *_CUT, *_FIRST])


def _keyed(batches):
    """Cut-out rows with a key of the string and the first of their places."""
    for batch in batches:
        ids = [hashlib.blake2b(cut, digest_size=16).digest() for cut in batch.column(1).to_pylist()]
        first = [min(np.frombuffer(p, _PLACE).tolist()) for p in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.binary()), *batch.columns, *[pa.array([f[k] for f in first], pa.int64()) for k in range(3)]], schema=_KEYED)


def _later_copies(batches):
    """All places of rows (places, size, first place) but the first, as covered stretches."""
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            packed, size, *first = (c.to_numpy(zero_copy_only=False) for c in batch.slice(k, 256).columns)
            copies = [len(p) // _PLACE.itemsize for p in packed]
            at = np.frombuffer(b"".join(packed), _PLACE)
            doc, mark, start, size = (np.repeat(x, copies) for x in (*first, size))
            late = (at["doc"] != doc) | (at["mark"] != mark) | (at["start"] != start)
            at, size = at[late], size[late]
            yield pa.record_batch([pa.array(x) for x in (at["doc"], at["mark"], at["start"], at["start"] + size)], schema=_COVERED)


def _at_first(batches):
    """Rows (anchor, string, recurs, first place) as cut-out rows with that one place."""
    for batch in batches:
        places = [np.array([p], _PLACE).tobytes() for p in zip(*[c.to_pylist() for c in batch.columns[3:]])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(places, pa.binary())], schema=_CUT)


class RunLengthIndex:
    """A run-compressed Burrows-Wheeler transform of strings, with contexts of ``length`` bytes.

    Rows of the transform are ordered by the ``length`` symbols that follow them. Kept
    are the runs of equal symbols (head, first row, count of the head before it),
    the first row of each context, and there the place of its first copy.
    """

    def __init__(self, strings: list[bytes], length: int):
        # Symbols 1 to 256 are bytes; 0 ends a string, so that no context spans two.
        text = np.zeros(sum(map(len, strings)) + len(strings), np.int64)
        joined = np.frombuffer(b"\0".join([*strings, b""]), np.uint8)
        text[:] = joined
        text += 1
        ends = np.cumsum([len(s) + 1 for s in strings]) - 1
        text[ends] = 0
        self.length, self.n = length, len(text)
        rank, done = self._by_seven(text), 7
        while 2 * done <= length:
            rank, done = self._together(rank, done), 2 * done
        order, context = self._ordered(rank, length - done)
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        before = text[order - 1]  # the symbol before place 0 is the end of the last string
        head_at = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        heads, sizes = before[head_at], np.diff(np.r_[head_at, self.n])
        by_head = np.lexsort((head_at, heads))
        self.run_key = heads[by_head] * self.n + head_at[by_head]  # runs by head, then first row
        self.run_size = sizes[by_head]
        total = np.cumsum(self.run_size) - self.run_size
        start = np.searchsorted(heads[by_head], np.arange(258))
        self.run_before = total - np.r_[total, self.n][start][heads[by_head]]  # of the same head
        self.smaller = np.searchsorted(np.sort(text), np.arange(258))  # symbols below each
        self.context_row = first
        self.sample = np.minimum.reduceat(order, first)

    @staticmethod
    def _by_seven(text: np.ndarray) -> np.ndarray:
        key, padded = np.zeros(len(text), np.int64), np.r_[text, np.zeros(6, np.int64)]
        for k in range(7):
            key = key << 9 | padded[k:k + len(text)]
        return np.unique(key, return_inverse=True)[1]

    def _pair(self, rank: np.ndarray, shift: int) -> np.ndarray:
        return rank * (self.n + 1) + (np.r_[rank[shift:] + 1, np.zeros(shift, np.int64)] if shift else 0)

    def _together(self, rank: np.ndarray, shift: int) -> np.ndarray:
        return np.unique(self._pair(rank, shift), return_inverse=True)[1]

    def _ordered(self, rank: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        key = self._pair(rank, shift)
        order = np.argsort(key)
        return order, key[order]

    def extend(self, row: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """First row of the matches of ``symbol`` before what ``row`` is the first row of."""
        at = np.searchsorted(self.run_key, symbol * self.n + row) - 1  # last run before the row, of any head
        same = (at >= 0) & (self.run_key[at] >= symbol * self.n)
        counted = np.where(same, self.run_before[at] + np.minimum(self.run_size[at], symbol * self.n + row - self.run_key[at]), 0)
        return self.smaller[symbol] + counted

    def context(self, row: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.context_row, row, "right") - 1

    def first_copies(self, strings: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Stream the indexed ``strings`` from right to left, all at once: for each step
        (string, start in it, place of the first copy of the window that starts there).
        A long string is streamed as pieces of ``STREAMED`` windows."""
        pieces = [(k, at, min(len(s), at + STREAMED + self.length - 1)) for k, s in enumerate(strings)
                  for at in range(0, len(s) - self.length + 1, STREAMED)]
        string, first, end = np.array(pieces).T
        sizes = end - first
        flat = np.frombuffer(b"".join(strings), np.uint8)
        base = np.cumsum([0, *map(len, strings)])[:-1]
        live = np.argsort(-sizes, kind="stable")  # longest first: the ones that go on are a prefix
        by_size, row = sizes[live], np.zeros(len(live), np.int64)
        string, end, last = string[live], end[live], (base[string] + end)[live]
        for step in range(1, int(by_size[0]) + 1):
            k = int(np.searchsorted(-by_size, -step, "right"))
            row[:k] = self.extend(row[:k], flat[last[:k] - step].astype(np.int64) + 1)
            if step >= self.length:
                context = self.context(row[:k])
                row[:k] = self.context_row[context]  # cut the match back to its first ``length`` bytes
                yield string[:k], end[:k] - step, self.sample[context]


_COVERED = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _covered(batches, length: int):
    """Covered stretches per document, from cut-out rows sorted by anchor."""

    def stretches(rows: list[tuple]):
        places: dict[bytes, list] = {}
        anchors: dict[bytes, int] = {}
        alike: dict[int, int] = {}  # different strings by anchor; one that recurs in itself counts as several
        for anchor, cut, recurs, packed in rows:
            if cut not in places:
                places[cut], anchors[cut] = [], anchor
                alike[anchor] = alike.get(anchor, 0) + 1 + recurs
            places[cut].extend(np.frombuffer(packed, _PLACE).tolist())
        docs, marks, starts, ends = [], [], [], []
        strings = []
        for cut, found in places.items():
            at = min(found)
            for d, m, s in set(found) - {at}:  # all of a later copy of a whole string is covered
                docs.append(d), marks.append(m), starts.append(s), ends.append(s + len(cut))
            if alike[anchors[cut]] > 1:  # else no window of it is anywhere else
                strings.append((at, cut))
        strings.sort()  # by first place, so that an earlier copy comes first
        cuts = [cut for _, cut in strings]
        if cuts:
            base = np.cumsum([len(c) + 1 for c in cuts]) - [len(c) + 1 for c in cuts]
            which, where = [], []
            for string, start, copy in RunLengthIndex(cuts, length).first_copies(cuts):
                late = copy != base[string] + start
                which.append(string[late])
                where.append(start[late])
            which, where = (np.concatenate(x) for x in (which, where))
            order = np.lexsort((where, which))
            which, where = which[order], where[order]
            if len(which):
                new = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (where[1:] > where[:-1] + 1)])
                for w, a, b in zip(which[new].tolist(), where[new].tolist(), where[np.r_[new[1:], len(where)] - 1].tolist()):
                    (d, m, s), _ = strings[w]
                    docs.append(d), marks.append(m), starts.append(s + a), ends.append(s + b + length)
        return pa.record_batch([pa.array(x, pa.int64()) for x in (docs, marks, starts, ends)], schema=_COVERED)

    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            for row in zip(*[c.to_pylist() for c in batch.slice(at, 1024).columns]):
                if size >= BATCH and row[0] != held[-1][0]:
                    yield stretches(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
    if held:
        yield stretches(held)


def _removed(ids: list, texts: list, stretches: list) -> dict[str, list]:
    out = {"doc_id": ids, "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
    for packed, covered in zip(texts, stretches):
        text = _unpack(packed)
        kept, end, spans = [], 0, 0
        for a, b in sorted((x["start"], x["end"]) for x in covered or ()):
            if a > end or not spans:
                spans += 1
                kept.append(text[end:a])
            end = max(end, b)
        kept.append(text[end:])
        rest = b"".join(kept)
        out["n_bytes"].append(len(text))
        out["n_removed"].append(len(text) - len(rest))
        out["n_spans"].append(spans)
        out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
    return out


_CUT_DDL = "anchor bigint, bytes binary, recurs boolean, places binary"
_COVERED_DDL = "doc bigint, mark bigint, start bigint, end bigint"


def _indexed(cut: DataFrame, length: int) -> DataFrame:
    return (cut.repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(lambda it: _covered(it, length), _COVERED_DDL))


def _hot_anchors(wanted: DataFrame) -> np.ndarray:
    """The anchors, fewer than ``1 / HOT_SHARE``, that hold at least that share of the copies counted."""
    counted = wanted.where("own is null").select(F.explode(F.arrays_zip("anchors", "copies")).alias("c")).select("c.*")
    total = counted.agg(F.sum("copies")).first()[0] or 0
    return np.sort(counted.where(F.col("copies") > HOT_SHARE * total).select("anchors").toArrow().column(0).to_numpy())


def _hot_stretches(packed: DataFrame, wanted: DataFrame, hot, length: int, most: int) -> DataFrame:
    """Covered stretches of the runs of windows whose anchor is in ``hot`` (a broadcast array)."""

    def own(batches):
        for batch in batches:
            anchors = batch.column(1).flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy())
            keep = np.isin(anchors, hot.value)
            row, anchors = row[keep], anchors[keep]
            start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][:len(row)])
            yield pa.record_batch([batch.column(0).take(pa.array(row[start])), _lists(anchors, start)], names=["own", "anchors"])

    wanted = materialize(wanted.where("own is not null").select("own", "anchors").mapInArrow(own, "own bigint, anchors array<bigint>"), "passages-hot-docs")
    cut = materialize(
        packed.join(wanted, "own").select("doc", "mark", "packed", "anchors").mapInArrow(
            lambda it: _keyed(_cut_out(it, length, np.zeros(0, np.int64))),
            f"id binary, {_CUT_DDL}, first_doc bigint, first_mark bigint, first_start bigint"), "passages-hot-cut")
    first = F.struct("first_doc", "first_mark", "first_start")
    strings = materialize(cut.groupBy("id", "anchor", "bytes").agg(F.max("recurs").alias("recurs"), F.min(first).alias("first"))
                          .select("id", "anchor", "bytes", "recurs", "first.*"), "passages-hot-strings")
    copies = (cut.select("id", "places", F.octet_length("bytes").alias("size"))
              .join(strings.select("id", "first_doc", "first_mark", "first_start"), "id")
              .select("places", "size", "first_doc", "first_mark", "first_start").mapInArrow(_later_copies, _COVERED_DDL))

    # Different strings of an anchor; one that recurs in itself counts as several.
    alike = materialize(strings.groupBy("anchor").agg(F.sum(1 + F.col("recurs").cast("int")).alias("alike")).where("alike > 1"), "passages-hot-alike")
    told = strings.join(alike, "anchor").select("anchor", "bytes", "recurs", "first_doc", "first_mark", "first_start", "alike")
    few = _indexed(told.where(F.col("alike") <= most).drop("alike").mapInArrow(_at_first, _CUT_DDL), length)
    window = F.substring(F.col("bytes"), F.col("at") + 1, F.lit(length))
    windows = (told.where(F.col("alike") > most)
               .withColumn("at", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)))
               .select(F.unhex(F.left(F.sha2(window, 256), F.lit(32))).alias("window"),
                       F.struct(F.col("first_doc").alias("doc"), F.col("first_mark").alias("mark"),
                                (F.col("first_start") + F.col("at")).alias("start")).alias("place")))
    least = materialize(windows.groupBy("window").agg(F.min("place").alias("least")), "passages-hot-windows")
    late = windows.join(least, "window").where("place <> least").select("place.*", (F.col("place.start") + length).alias("end"))
    return copies.unionByName(few).unionByName(late)


def covered_stretches(docs: DataFrame, packed: DataFrame, length: int = 100, hot: int = HOT) -> DataFrame:
    """(doc, mark, start, end): covered bytes of ``docs(own, bytes)``, which are also in
    ``packed(own, doc, mark, packed)``; stretches may overlap. ``own`` tells apart what
    rows with different texts have; rows that share it get each other's anchors too."""
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = (docs.select("own", "bytes").mapInArrow(lambda it: _anchor_parts(it, length, parts), "part int, kind int, anchors array<bigint>, docs array<bigint>")
               .repartition("part").mapInArrow(lambda it: _repeated(it, parts, hot), "group int, anchors array<bigint>, docs array<bigint>, counted boolean"))
    wanted = materialize(counted.repartition("group").mapInArrow(_by_document, "own bigint, anchors array<bigint>, copies array<bigint>"), "passages-wanted")
    anchors = _hot_anchors(wanted)
    shared = docs.sparkSession.sparkContext.broadcast(anchors)
    cut = (packed.join(wanted, "own").select("doc", "mark", "packed", "anchors")
           .mapInArrow(lambda it: _cut_out(it, length, shared.value), _CUT_DDL))
    covered = _indexed(cut, length)
    return covered.unionByName(_hot_stretches(packed, wanted, shared, length, hot)) if len(anchors) else covered


def _with_own(docs: DataFrame) -> DataFrame:
    """``docs(doc, bytes)`` with ``own``: the doc, or a hash of doc and text where the doc may
    be that of several rows, so that none of them gets the anchors of the others.

    Which docs are shared is told by ``_SLOTS`` slots at most, a proven bound for the
    broadcast; a doc that falls in the slot of a shared one is hashed too, which does no harm.
    """
    slot = F.pmod(F.xxhash64("doc"), F.lit(_SLOTS)).cast("int").alias("slot")
    shared = materialize(docs.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(slot).distinct(), "passages-shared")
    told = docs.select("*", slot).join(F.broadcast(shared.withColumn("shared", F.lit(True))), "slot", "left")
    return told.withColumn("own", F.when(F.col("shared"), F.xxhash64("doc", F.xxhash64("bytes"))).otherwise(F.col("doc"))).drop("slot", "shared")


def remove_repeats(docs: DataFrame, length: int = 100, hot: int = HOT) -> DataFrame:
    """Remove every byte that a ``length``-byte string covers which also starts earlier.

    Works on the UTF-8 bytes of the whole texts of ``docs(doc_id, text)``; earlier
    is a smaller doc_id, or the same document and an earlier start; matches never
    cross documents and are judged on the input. Returns doc_id, n_bytes,
    n_removed, n_spans (maximal removed runs), kept_sha256. A null text counts as
    empty; a text shorter than ``length`` is left whole; null doc_ids come after
    all others; of rows that share a doc_id the one with the smaller text hash
    counts as earlier, and rows equal in both are one document; an empty table
    gives no rows; other columns are not read. Very long texts are hashed, cut and
    indexed in pieces that lose no match. An anchor with more than ``hot``
    copies is not gathered in one group; results don't depend on it. A doc_id that
    is no whole number is a ValueError.
    """
    if docs.schema["doc_id"].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError("doc_id must be a column of whole numbers")
    d = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"),
                    F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("bytes"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    d = _with_own(d)
    packed = d.select("doc_id", "doc", F.xxhash64("bytes").alias("mark"), "own", "bytes").mapInArrow(
        _packed, f"doc_id {id_type}, doc bigint, mark bigint, own bigint, packed binary")
    with scratch(docs.sparkSession) as kept:
        covered = covered_stretches(d, packed, length, hot)
        per_doc = materialize(covered.groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "end")).alias("covered")), "passages-covered")
        kept.append(per_doc)
    schema = f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def batches(it):
        for batch in it:
            for at in range(0, batch.num_rows, 256):
                out = _removed(*(c.to_pylist() for c in batch.slice(at, 256).columns))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return packed.join(per_doc, ["doc", "mark"], "left").select("doc_id", "packed", "covered").mapInArrow(batches, schema)
