"""Pages of a document of over 500 lines are pages of their own and not those of the next document."""

import duckdb

import __spark_entry__ as driver


def test_long_documents_keep_their_pages(spark, tmp_path):
    long = "\n".join(f"word{i} alpha" for i in range(530))
    spark.createDataFrame([(1, long), (2, "alpha beta\ngamma"), (3, None), (4, "delta")], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "word501 alpha"), (1, "gamma beta"), (2, "delta word7")], "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for name in ("page_search", "missing_coverage"):
        out = driver.queries()[name](spark, str(tmp_path))
        got = sorted(map(tuple, out.collect()))
        assert got == sorted(con.execute(f"select {', '.join(out.columns)} from ({driver.oracle_sql()[name]})").fetchall())
    ids = [r["id"] for r in driver.queries()["page_search"](spark, str(tmp_path)).collect()]
    assert {1_000_000_101, 2_000_000_001} <= set(ids)
