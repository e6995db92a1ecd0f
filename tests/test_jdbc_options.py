"""JDBC option mapping, checked with a recording stand-in for the reader/writer.

No database is started or contacted (none may run here); these tests pin what
the functions hand to Spark's JDBC source.
"""

import pytest

from martlet.sources import jdbc


class _Rec:
    def __init__(self):
        self.calls = []
        self.opts = {}

    def format(self, f):
        self.calls.append(("format", f))
        return self

    def options(self, **o):
        self.opts.update(o)
        return self

    def mode(self, m):
        self.calls.append(("mode", m))
        return self

    def load(self):
        self.calls.append(("load",))
        return "frame"

    def save(self):
        self.calls.append(("save",))


class _Spark:
    def __init__(self):
        self.read = _Rec()


class _Frame:
    def __init__(self):
        self.write = _Rec()


OPTS = {"url": "jdbc:x://h/db", "user": "u", "password": "p"}


def test_read_table_uses_query_or_dbtable():
    s = _Spark()
    jdbc.read_table(s, OPTS, query="select * from t")
    assert s.read.opts["query"] == "select * from t" and "dbtable" not in s.read.opts
    s = _Spark()
    jdbc.read_table(s, OPTS, table="t")
    assert s.read.opts["dbtable"] == "t" and ("format", "jdbc") in s.read.calls


def test_partitioned_read_options_with_given_bounds():
    s = _Spark()
    jdbc.read_partitioned(s, OPTS, "(select * from t) q", "k", 11, bounds=(1, 5000), fetch_size=10000)
    o = s.read.opts
    assert (o["dbtable"], o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"],
            o["fetchsize"]) == ("(select * from t) q", "k", "1", "5000", "11", "10000")
    assert "query" not in o                      # Spark cannot combine query with partitionColumn


def test_partitioned_read_rejects_out_of_range_partitions():
    with pytest.raises(ValueError):
        jdbc.read_partitioned(_Spark(), OPTS, "t", "k", 0, bounds=(0, 1))


def test_write_table_append_and_overwrite_options():
    f = _Frame()
    jdbc.write_table(f, OPTS, "t_proc", mode="append", create_table_options="ENGINE=X ORDER BY code")
    assert f.write.opts["createTableOptions"] == "ENGINE=X ORDER BY code" and ("mode", "append") in f.write.calls
    f = _Frame()
    jdbc.write_table(f, OPTS, "t_proc", mode="overwrite", truncate=True, num_partitions=8)
    assert f.write.opts["truncate"] == "true" and f.write.opts["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc.write_table(_Frame(), OPTS, "t", mode="upsert")
