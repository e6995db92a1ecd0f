"""Personal data by bootstrapped contextual extraction (operator 3).

Only DataFrame and SQL functions. Entities that plain forms find (e-mail and IP
addresses, card and phone numbers) are the seeds. The words before a seed are a
lexical pattern. Patterns and the identifiers they introduce form a bipartite
graph: a pattern scores by the share of its identifiers that are known, an
identifier by its best pattern, over several rounds. Identifiers in the context
of a high-confidence pattern are reported though no plain form fits them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import discard, materialize

# The kinds in their order and their forms. Possessive, and an e-mail or
# an IP address starts where its run of characters starts or the last match ended: the
# matches are those of the plain forms, without scanning a long run again and again.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a form to have a valid match in it.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){12}[0-9]", "phone": r"\+[0-9]"}
#: An identifier of no plain form: 6 characters or more, four digits among them, between spaces.
#: Possessive, so that a very long run without a space costs its length.
IDENTIFIER = r"(?<!\S)(?=(?:[^\s0-9]*+[0-9]){4})\S{6,}+"
IDENTIFIER_HINT = r"[0-9](?:[^\s0-9]*+[0-9]){3}"
LOOK_BACK = 50
#: At least ``LOOK_BACK``.
_CHUNK = 256


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


_SPANS = "array<struct<kind:int,start:int,end:int,value:string>>"


#: Matches that are located one after the other; growing a longer array by ones costs its square.
_RUN = 256
#: Spans by start before an identifier that may hold a base span reaching it.
_NEIGHBOURS = 16


def _located(matches: str, pieces: str, kind: int) -> Column:
    """Spans of the ``matches`` between the ``pieces`` of a split text (two column names):
    first where each run of matches starts, then the matches of each run."""
    n = F.size(matches)
    runs = F.sequence(F.lit(0), F.floor((n - 1) / _RUN).cast("int"))
    places = lambda r: F.sequence(r * _RUN, F.least(r * _RUN + _RUN, n) - 1)
    at = lambda acc, i: acc["at"] + F.length(F.get(F.col(pieces), i))
    end = lambda acc, i: at(acc, i) + F.length(F.get(F.col(matches), i))
    size = lambda r: F.aggregate(places(r), F.lit(0), lambda acc, i: acc + F.length(F.get(F.col(pieces), i)) + F.length(F.get(F.col(matches), i)))
    starts = F.aggregate(
        F.slice(F.transform(runs, size), F.lit(1), F.size(runs) - 1), F.array(F.lit(0)),
        lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    within = lambda start, r: F.aggregate(
        places(r), F.struct(start.alias("at"), F.array().cast(_SPANS).alias("out")),
        lambda acc, i: F.struct(end(acc, i).alias("at"), F.concat(acc["out"], F.array(F.struct(
            F.lit(kind).alias("kind"), at(acc, i).alias("start"), end(acc, i).alias("end"),
            F.get(F.col(matches), i).alias("value")))).cast(_SPANS).alias("out")),
        lambda acc: acc["out"])
    return F.flatten(F.transform(starts, within))


def _with_spans(df: DataFrame, name: str, form: str, hint: str, kind: int) -> DataFrame:
    """``df(text)`` with the located matches of ``form`` as column ``name``."""
    m, p = f"{name}_m", f"{name}_p"
    return (df.withColumn(m, F.when(F.col("hinted") & F.col("text").rlike(hint), F.regexp_extract_all("text", F.lit(form), F.lit(0))))
            .withColumn(p, F.when(F.size(m) > 0, F.split("text", form, -1)))
            .withColumn(name, F.when(F.size(m) > 0, _located(m, p, kind)).otherwise(F.array().cast(_SPANS)))
            .drop(m, p))


def _pattern(chunks: Column, start: Column) -> Column:
    """The words before ``start``: one that ends like a label, or two; null without.
    ``chunks`` is the text in pieces of ``_CHUNK``: a place in a long text costs its length to find."""
    k = F.floor(start / _CHUNK).cast("int")
    at = F.when(k > 0, start - (k - 1) * _CHUNK).otherwise(start)
    around = F.concat(F.when(k > 0, F.get(chunks, k - 1)).otherwise(""), F.get(chunks, k))
    before = F.substring(around, F.greatest(at - LOOK_BACK, F.lit(0)) + 1, F.least(at, F.lit(LOOK_BACK)))
    last = F.regexp_extract(before, r"(\S{1,24})\s*$", 1)
    two = F.regexp_extract(before, r"(\S{1,24})\s+\S{1,24}\s*$", 1)
    return F.when(last.rlike("[:=#]$"), F.lower(last)).when(two != "", F.lower(F.concat_ws(" ", two, last)))


def _read(docs: DataFrame) -> DataFrame:
    """One scan of the texts: (doc_id, mark, base, known and unknown identifiers with
    their patterns). ``mark`` hashes the text, so that rows that share a doc_id stay apart."""
    df = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    df = df.withColumn("mark", F.xxhash64("text")).withColumn("hinted", F.col("text").rlike("[0-9@]"))
    for n, (kind, form) in enumerate(FORMS.items()):
        df = _with_spans(df, kind, form, HINTS[kind], n)
        df = df.withColumn(kind, F.filter(kind, lambda s: _valid(kind, s["value"])))
    df = _with_spans(df, "identifier", IDENTIFIER, IDENTIFIER_HINT, len(FORMS))
    df = df.withColumn("base", F.concat(*FORMS))
    # Base spans around an identifier are its neighbours by start: one of up to 19 digits that
    # reaches it has few others inside, and the first that starts inside it comes next.
    brief = lambda name: F.transform(name, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    df = df.withColumn("places", F.array_sort(F.concat(brief("base"), brief("identifier"))))
    near = lambda i: F.slice("places", F.greatest(i + 1 - _NEIGHBOURS, F.lit(1)), _NEIGHBOURS + 2)
    free = F.filter("places", lambda c, i: (c["kind"] == len(FORMS)) & ~F.exists(
        near(i), lambda s: (s["kind"] < len(FORMS)) & (s["start"] < c["end"]) & (c["start"] < s["end"])))
    told = lambda c, known: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value"),
                                     _pattern(F.col("chunks"), c["start"]).alias("pattern"), F.lit(known).alias("known"))
    chunks = F.when(F.size("places") > 0, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0)))
    return df.withColumn("free", free).withColumn("chunks", chunks).select(
        "doc_id", "mark", F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("base"),
        F.concat(F.transform("base", lambda s: told(s, 1)), F.transform("free", lambda s: told(s, 0))).alias("seen"))


def score_patterns(seen: DataFrame, rounds: int = 3, least_seeds: int = 5, confidence: float = 0.8) -> DataFrame:
    """Patterns (pattern, score, seeds) of at least ``confidence`` from
    ``seen(pattern, value, known)``.

    A round scores each pattern by the mean score of its distinct identifiers
    (known ones count 1), and each unknown identifier by its best pattern, if
    that has the confidence and ``least_seeds`` identifiers that are known or
    trusted. Both directions are partial aggregates and joins that Spark can
    split, as their small sides are written out first.
    """
    edges = materialize(seen.where("pattern is not null").groupBy("pattern", "value")
                        .agg(F.max("known").cast("double").alias("score")), "pii-edges")
    for n in range(rounds):
        good = materialize(
            edges.groupBy("pattern").agg(F.avg("score").alias("score"), F.sum((F.col("score") >= confidence).cast("int")).alias("seeds"))
            .where((F.col("score") >= confidence) & (F.col("seeds") >= least_seeds)), "pii-patterns")
        if n == rounds - 1:
            discard(edges)
            return good
        trusted = materialize(edges.where("score < 1").join(good.select("pattern", F.col("score").alias("s")), "pattern")
                              .groupBy("value").agg(F.max("s").alias("s")), "pii-trusted")
        again = materialize(edges.join(trusted, "value", "left").select(
            "pattern", "value", F.greatest("score", F.coalesce("s", F.lit(0.0))).alias("score")), "pii-edges")
        for gone in (edges, good, trusted):
            discard(gone)
        edges = again
    raise ValueError("rounds must be positive")


def _spans(docs: DataFrame, **parameters) -> DataFrame:
    """(doc_id, mark, base, more): base spans and discovered ones of every row."""
    read = materialize(_read(docs), "pii-read")
    seen = read.select("doc_id", "mark", F.explode("seen").alias("s")).select("doc_id", "mark", "s.*")
    good = score_patterns(seen, **parameters)
    found = (seen.where("known = 0").join(good.select("pattern"), "pattern")
             .groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("more")))
    r, f = read.alias("r"), materialize(found, "pii-found").alias("f")
    return r.join(f, F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.mark") == F.col("f.mark")), "left").select(
        "r.doc_id", "r.mark", "r.base", F.coalesce("f.more", F.array().cast("array<struct<start:int,end:int>>")).alias("more"))


def find_pii(docs: DataFrame, **parameters) -> DataFrame:
    """Personal data in every whole text of ``docs(doc_id, text)``.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (all as
    kind:start:end in code points, end exclusive, by kind as listed and then
    start; discovered ones have the kind ``context`` and come last). A null text
    counts as empty (no spans); repeated rows give repeated rows, and rows that
    share a doc_id are kept apart by their text; an empty table gives none; other
    columns are not read; very long texts and identifiers are read whole. Of patterns
    that tie all that have the confidence count.
    """
    names = F.array(*[F.lit(k) for k in FORMS])
    told = F.transform("base", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    more = F.transform("more", lambda s: F.concat_ws(":", F.lit("context"), s["start"], s["end"]))
    count = lambda n: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")
    return _spans(docs, **parameters).select(
        "doc_id", *[count(n).alias(f"n_{kind}") for n, kind in enumerate(FORMS)],
        F.sha2(F.concat_ws(",", told), 256).alias("base_sha256"), F.concat_ws(",", F.concat(told, more)).alias("spans"))


def mask_pii(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with every span of ``find_pii`` replaced by its kind in angle
    brackets, and all other columns as they are. Of overlapping spans the first
    names the mask. A null text stays null."""
    names = F.array(*[F.lit(f"<{k}>") for k in (*FORMS, "context")])
    spans = _spans(docs, **parameters).select(
        "doc_id", "mark", F.array_sort(F.concat(
            F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))),
            F.transform("more", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(len(FORMS)).alias("kind")))
        )).alias("spans")).where(F.size("spans") > 0)
    spans = materialize(spans.groupBy("doc_id", "mark").agg(F.first("spans").alias("spans")), "pii-mask")
    d = docs.withColumn("__mark", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))).alias("d")
    text = F.col("d.text")
    masked = F.aggregate(
        "p.spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"])).alias("out")))
        .otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return d.join(spans.alias("p"), F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.__mark") == F.col("p.mark")), "left").select(
        *[F.when(F.col("p.spans").isNotNull(), masked).otherwise(text).alias("text") if c == "text" else F.col(f"d.`{c}`")
          for c in docs.columns])
