"""Word frequencies over a text column.

Plan shape: scan -> Generate(explode(split(lower))) -> Filter(NOT IN set) ->
partial count -> hash exchange on word -> final count [-> range exchange -> sort].
A word that holds a third of all tokens is harmless: the partial (map-side)
aggregate collapses it to one row per input partition before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.stopwords import default_stop_words

# Fixed value: the tokeniser pattern (Java regex, ASCII \W), split limit -1.
WORD_SPLIT_PATTERN = r"\W+"
# Option: the same split with Unicode word characters (keeps accented letters).
UNICODE_WORD_SPLIT_PATTERN = r"(?U)\W+"


def tokenize(df: DataFrame, text_col: str, word_col: str = "word",
             keep: list[str] | None = None, drop_empty: bool = False,
             pattern: str = WORD_SPLIT_PATTERN, partitions: int | None = None,
             outer: bool = False) -> DataFrame:
    """One row per token of ``lower(text)`` split on ``pattern``.

    NULL text yields no rows (one row with a NULL token when ``outer``); ``''``
    yields one empty token (Spark's split keeps leading/trailing empties).
    ``drop_empty`` removes empty tokens; ``UNICODE_WORD_SPLIT_PATTERN`` keeps
    accented letters inside words. ``partitions`` deals the texts out anew, for an
    input of a few large splits; by default nothing is shuffled before the split.
    """
    keep = keep or []
    if partitions is not None:
        df = df.select(*keep, text_col).repartition(partitions)
    gen = F.explode_outer if outer else F.explode
    out = df.select(*keep, gen(F.split(F.lower(F.col(text_col)), pattern, -1)).alias(word_col))
    if drop_empty:
        out = out.where(F.col(word_col) != "")
    return out


def remove_stop_words(df: DataFrame, word_col: str = "word", stop_words=None,
                      language: str = "english") -> DataFrame:
    """Keep tokens not in the stop list (``NOT IN``; a NULL token is dropped).

    The list is a bounded constant (181 words), so it compiles to an ``InSet``
    predicate inside the same codegen stage: no join, no broadcast.
    """
    words = list(stop_words) if stop_words is not None else list(default_stop_words(language))
    return df.where(~F.col(word_col).isin(words))


def word_count(df: DataFrame, text_col: str, stop_words=None, drop_empty: bool = False,
               sort: bool = True, partitions: int | None = None) -> DataFrame:
    """(word, count) for all non-stop-words, most frequent first, ties by word."""
    tokens = remove_stop_words(tokenize(df, text_col, drop_empty=drop_empty, partitions=partitions), stop_words=stop_words)
    counts = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    if sort:
        counts = counts.orderBy(F.col("count").desc(), F.col("word").asc())
    return counts


def word_topk(df: DataFrame, text_col: str, k: int = 20, stop_words=None) -> DataFrame:
    """The ``k`` most frequent words (``show()`` default is 20).

    ``orderBy().limit(k)`` plans as ``TakeOrderedAndProject``: each partition
    keeps its own top k, so only k rows per partition cross the network.
    """
    counts = word_count(df, text_col, stop_words=stop_words, sort=False)
    return counts.orderBy(F.col("count").desc(), F.col("word").asc()).limit(k)


def token_counts(df: DataFrame, text_col: str, keys: list[str], stop_words=None) -> DataFrame:
    """Per input row: number of tokens and number left after the stop-word filter."""
    words = list(stop_words) if stop_words is not None else list(default_stop_words())
    tokens = F.split(F.lower(F.col(text_col)), WORD_SPLIT_PATTERN, -1)
    return df.where(F.col(text_col).isNotNull()).select(
        *keys,
        F.size(tokens).cast("long").alias("n_tokens"),
        F.size(F.filter(tokens, lambda w: ~w.isin(words))).cast("long").alias("n_kept"),
    )
