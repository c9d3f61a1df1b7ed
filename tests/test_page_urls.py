"""Page URLs of every title, those with a plus sign too."""

import __spark_entry__


def test_titles_with_a_plus(spark, tmp_path):
    spark.createDataFrame([(1, "C++ tools"), (2, "A/B"), (3, None)], "doc_id bigint, page_title string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in __spark_entry__.queries()["page_urls"](spark, str(tmp_path)).select("page_title", "url").collect()}
    assert got == {("C++ tools", "https://en.wikipedia.org/wiki/C%2B%2B_tools"), ("A/B", "https://en.wikipedia.org/wiki/A/B")}
