"""Repeated passages with short sentences, through the query."""

from tidestrata.llm import queries


def test_short_units_of_a_passage_are_cut(spark, tmp_path):
    passage = "It rained all day in town. Why? No one knew. The river rose over its banks again. So it goes."
    rows = [(1, f"Before it.\n{passage}\nAfter it."), (2, f"Something else.\n{passage}\nAnd more."), (3, None), (4, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op6_unit_dedup(spark, str(tmp_path)).collect()}
    assert found[1].text == rows[0][1] and found[3].text is None and found[4].text == ""
    assert found[2].text.split() == "Something else. And more.".split()
    assert [s.first_id for s in found[2].removed] == [1] * 5
