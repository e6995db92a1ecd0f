"""Secret scans with multipart credential linking (operator 9).

Strong forms (an assignment, an access key, a long hex string) are reported
alone. A credential often comes in parts: an access identifier, a secret and an
endpoint, each too weak to report. The parts of a text are sorted by place and
joined by interval inside their scope (lines without a blank line between them,
parts at most ``REACH`` characters apart); a weak part is reported only when an
identifier and a secret co-occur side by side (one string is never both), and an
endpoint only beside both. Names may have a prefix, as in ``aws_access_key_id``.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame

from martlet.llm.common import map_texts

# The base kinds in their order, with the least length of the part that counts.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_KEYWORD = re.compile(r"(?ai:passw|secret|token|api_?key)")

#: Characters between the ends of two parts that may still belong together.
REACH = 200
#: Bits per character below which a string is taken for a word, not a secret.
LEAST_ENTROPY = 3.0
_IDENTIFIER = re.compile(r"""(?ai:(?<![A-Za-z0-9])(?<!secret[_-])(?:access_?key(?:_?id)?|key_?id|client_?id|account_?id|user(?:name)?|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{4,})""")
_ENDPOINT = re.compile(r"""(?a:(?<![A-Za-z0-9])(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._:/@-]{4,})|(?ai:(?<![A-Za-z0-9])(?:endpoint|host(?:name)?))["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:/-]{4,}""")
# A run of at least 16, whatever its length, without a name and '=' before it. Possessive, so that it is linear.
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z0-9+/_-]*+=(?=[A-Za-z0-9+/_-]))?+"
                     r"((?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{16,}+)")
_CUE = re.compile(r"(?ai:access_?key|key_?id|client_?id|account_?id|user|login|AKIA)")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strong forms, leftmost and not overlapping per kind."""
    out = []
    if _KEYWORD.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def linked_parts(text: str, base: list[tuple[int, int, int]], reach: int = REACH) -> list[tuple[int, int, str]]:
    """(start, end, kind) of weak parts whose complements stand within ``reach`` in the same scope."""
    access = [(s, e) for s, kind, e in base if kind == 1]
    if not access and not _CUE.search(text):
        return []  # no identifier, so nothing can be linked
    identifiers = sorted({*access, *((m.start(), m.end()) for m in _IDENTIFIER.finditer(text))})
    if not identifiers:
        return []
    taken = {(s, e) for s, _, e in base}
    secrets = [m.span(1) for m in _SECRET.finditer(text) if entropy(m[1]) >= LEAST_ENTROPY]
    secrets = sorted({*secrets, *((s, e) for s, kind, e in base if kind != 1)})
    access = by_length(access)
    secrets = by_length(x for x in secrets if not any(s <= x[0] < e for s, e in near(access, x, 0)))
    endpoints = by_length(sorted((m.start(), m.end()) for m in _ENDPOINT.finditer(text)))
    breaks = [m.start() for m in re.finditer(r"\n[\x20\t]*\n", text)]

    def beside(part, others):
        scope = bisect.bisect(breaks, part[0])
        return [o for o in near(others, part, reach)
                if (o[1] <= part[0] or part[1] <= o[0]) and bisect.bisect(breaks, o[0]) == scope]

    found = set()
    for ident in identifiers:
        if partners := beside(ident, secrets):
            found.add((*ident, "weak_id"))
            found.update((*p, "weak_secret") for p in partners)
            for end in beside(ident, endpoints):
                if any(max(end[0] - p[1], p[0] - end[1]) <= 2 * reach for p in partners):
                    found.add((*end, "weak_endpoint"))
    return sorted(x for x in found if x[:2] not in taken)


def by_length(parts) -> dict[int, list[tuple[int, int]]]:
    """``parts`` (sorted by start) by the bits of their length, so that each list knows its longest within a factor of two."""
    out: dict[int, list[tuple[int, int]]] = {}
    for p in parts:
        out.setdefault((p[1] - p[0]).bit_length(), []).append(p)
    return out


def near(parts: dict[int, list[tuple[int, int]]], part: tuple[int, int], reach: int) -> list[tuple[int, int]]:
    """The ``parts`` (by length) of any length within ``reach`` of ``part``."""
    found = []
    for bits, some in parts.items():
        lo = bisect.bisect_left(some, (part[0] - reach - (1 << bits),))
        hi = bisect.bisect_right(some, (part[1] + reach, math.inf))
        found += [p for p in some[lo:hi] if p[1] + reach >= part[0]]
    return found


def find_secrets(docs: DataFrame) -> DataFrame:
    """Secrets in every whole text of ``docs(doc_id, text)``.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256, spans (all spans as
    kind:start:end in code points, end exclusive, by start and then kind). A null
    text counts as empty (no spans); repeated rows give repeated rows; an empty
    table gives none; other columns are not read. Scopes lie inside a text, so
    the interval join needs no shuffle: it runs sorted where the row is read.
    """
    order = {k: n for n, k in enumerate((*KINDS, "weak_endpoint", "weak_id", "weak_secret"))}

    def run(ids: list, texts: list) -> dict[str, list]:
        out = {c: [] for c in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for i, text in zip(ids, texts):
            base = base_spans(text or "")
            told = [(s, KINDS[k], e) for s, k, e in base]
            joined = ",".join(f"{k}:{s}:{e}" for s, k, e in told)
            if more := linked_parts(text or "", base):
                told = sorted([*told, *((s, k, e) for s, e, k in more)], key=lambda x: (x[0], order[x[1]], x[2]))
            out["doc_id"].append(i)
            for n, kind in enumerate(KINDS):
                out[f"n_{kind}"].append(sum(k == n for _, k, _ in base))
            out["base_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
            out["spans"].append(",".join(f"{k}:{s}:{e}" for s, k, e in told))
        return out

    return map_texts(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_assign bigint, "
                                "n_access bigint, n_hex bigint, base_sha256 string, spans string")
