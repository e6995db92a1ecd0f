from martlet.session import shared_dir
from martlet.sources.tables import read_latest
from martlet.streaming.word_count import start_word_count


def test_stream_counts_grow_with_appended_files(spark):
    base = shared_dir(spark, "stream_test")
    src = f"{base}/src"
    schema = spark.createDataFrame([], "doc_id long, text string").schema
    spark.createDataFrame([(1, "red fish blue fish")], schema).write.parquet(f"{src}/batch=1")
    name = "t_stream_" + base.rsplit("-", 1)[-1]

    def run():
        q = start_word_count(spark, f"{src}/*", schema, "text", name, f"{base}/table", f"{base}/ckpt")
        q.awaitTermination()
        return {r.word: r["count"] for r in read_latest(spark, name).collect()}

    assert run() == {"red": 1, "fish": 2, "blue": 1}
    spark.createDataFrame([(2, "one fish"), (3, None)], schema).write.parquet(f"{src}/batch=2")
    assert run() == {"red": 1, "fish": 3, "blue": 1, "one": 1}   # only the new file is read
