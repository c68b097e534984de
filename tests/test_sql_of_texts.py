"""Texts on which queries came to differ from their SQL at 1 GB."""

import duckdb
import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.plans import catalog

LINES = ["first", "5.6.7.8 after a code", "7", "1 (826) 555", "4703443633947811 long", "SP9001 twice", "ex 12 sv 401", " 3 blanks"]
PAGES = ["<title>token = &quot</title><p>token = &quot;x&quot; &amp; y &amp</p>", "<p>a &lt b &copy &#3 &#39</p>&quot", "<p>&copy; &middot; &lt;b&gt; &#39;q&#39;</p><a href='?a=1&copy=2'>z &am &a &</a>"]


def both(spark, path, name):
    got = catalog.QUERIES[name](spark, str(path))
    with duckdb.connect() as con:
        for table in path.glob("*.parquet"):
            con.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}/*.parquet')")
        want = con.sql(catalog.ORACLES[name])
        return sorted(map(tuple, got.select(*want.columns).collect())), sorted(want.fetchall())


@pytest.mark.parametrize("name", ["code_extraction", "canonical_text", "refine_stats", "dense_pages"])
def test_a_digit_after_a_code_is_none_of_its_own(spark, tmp_path, name):
    rows = [(i, "\n".join(LINES)) for i in range(7)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got, want = both(spark, tmp_path, name)
    assert got == want and got


def test_digits_apart_are_a_code_by_default(spark):
    assert spark.range(1).select(T.codes(F.lit("SP-9005 6.7"))).first()[0] == ["SP90056"]


@pytest.mark.parametrize("name", ["html_items", "html_blocks"])
def test_references_without_semicolon(spark, tmp_path, name):
    spark.createDataFrame(list(enumerate(PAGES)), "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got, want = both(spark, tmp_path, name)
    assert got == want and len(got) == len(PAGES)
