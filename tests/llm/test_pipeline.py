import os
import re

import __spark_entry__ as entry
import corpus_pipeline
import duckdb
import pytest

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_shrink(s, docs):
    cur = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(s, cur, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        cur = s.createDataFrame(out.collect(), out.schema)
    assert cur.count() > 0 and "sequence_id" in cur.columns


def test_pipeline_of_odd_rows(s, odd, none, tmp):
    base = odd.drop("_text", "node")
    s.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp}/labels.parquet")
    for name, df in (("odd", base), ("none", none.drop("_text", "node"))):
        cur = df
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            cur = stage(s, cur, tmp)
        rows = cur.collect()
        assert all(r.offset + r.length <= 4096 for r in rows)


@pytest.mark.parametrize("name", ["op2_chat_format", "op5_warc_index", "op10_substring_dedup",
                                  "op13_fill_in_middle"])
def test_queries_equal_their_sql(s, name):
    got = entry.queries()[name](s, SF)
    cols = sorted(got.columns)
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    cur = con.execute(f"SELECT {', '.join(cols)} FROM ({entry.oracle_sql()[name]})")
    want = cur.fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(key, want))


def test_one_query_per_operator():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
