
from martlet.functions.stopwords import default_stop_words
from martlet.operators import text


def test_stop_word_list_is_sparks_default(spark):
    from pyspark.ml.feature import StopWordsRemover
    words = default_stop_words()
    assert len(words) == 181
    assert list(words) == list(StopWordsRemover.loadDefaultStopWords("english"))


def test_tokenize_golden(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Don't STOP"), (4, "ünï")], "id int, t string")
    toks = {r["id"]: [] for r in df.collect()}
    for r in text.tokenize(df, "t", keep=["id"]).collect():
        toks[r["id"]].append(r["word"])
    assert toks[1] == []               # NULL -> no rows
    assert toks[2] == [""]             # '' -> one empty token
    assert toks[3] == ["don", "t", "stop"]
    assert toks[4] == ["", "n", ""]     # ASCII \W splits on accented letters


def test_stop_word_filter_golden(spark):
    df = spark.createDataFrame([("Don't STOP",)], "t string")
    words = [r["word"] for r in text.word_count(df, "t").collect()]
    assert words == ["stop"]           # don, t are stop-words


def test_word_count_ties_broken_by_word(spark):
    df = spark.createDataFrame([("b a c b a c zed",)], "t string")
    got = [(r["word"], r["count"]) for r in text.word_count(df, "t").collect()]
    assert got == [("b", 2), ("c", 2), ("zed", 1)]  # 'a' is a stop word


def test_topk_plan_is_take_ordered(spark):
    df = spark.createDataFrame([("x y z",)], "t string")
    plan = text.word_topk(df, "t", k=20)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_word_count_plan_has_partial_aggregate(spark):
    from tests.conftest import SF_SMALL
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    q = text.word_count(df, "text", sort=False)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2      # partial + final
    assert "ReadSchema: struct<text:string>" in plan  # only the text column is read


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "The cat and the hat"), (2, None)], "id int, t string")
    got = text.token_counts(df, "t", ["id"]).collect()
    assert [(r.id, r.n_tokens, r.n_kept) for r in got] == [(1, 5, 2)]


def test_tokenize_shuffles_only_when_asked(spark):
    narrow = spark.createDataFrame([("a b",)], "t string").coalesce(1)
    assert "Exchange" not in text.tokenize(narrow, "t")._jdf.queryExecution().executedPlan().toString()
    assert text.tokenize(narrow, "t", partitions=5).rdd.getNumPartitions() == 5


def test_tokenize_outer_and_unicode_options(spark):
    df = spark.createDataFrame([(1, None), (2, "Ünï café")], "id int, t string")
    outer = [(r.id, r.word) for r in text.tokenize(df, "t", keep=["id"], outer=True).collect()]
    assert (1, None) in outer
    uni = [r.word for r in text.tokenize(df, "t", keep=["id"], pattern=text.UNICODE_WORD_SPLIT_PATTERN).collect()]
    assert uni == ["ünï", "café"]
