"""The pipeline over tables of its own: nulls, empty and repeated texts, clashing columns, no rows."""

import pytest

import corpus_pipeline

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, key string, id int"


@pytest.fixture
def folder(spark, tmp_path):
    """Tables of a few documents, some without ids or texts, and columns named like ones used inside."""

    def make(rows):
        full = [(i, t, "en", "web", len(t or ""), 7, "k", 3) for i, t in rows]
        spark.createDataFrame(full, DOCUMENT).write.parquet(f"{tmp_path}/documents.parquet")
        labels = [(i, 1, 0) for i, _ in rows if i is not None]
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        item = [(1, "the quick brown fox jumps over the lazy dog by the river")]
        spark.createDataFrame(item, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return make


def test_stages_on_odd_rows(spark, folder):
    long = " ".join(f"word{i}" for i in range(3000))
    rows = [
        (1, None),
        (2, ""),
        (None, "no id"),
        (3, "Same text here"),
        (4, "same text here"),
        (4, "same text here"),
        (5, long),
        (6, long + " "),
        (7, "once the quick brown fox jumps over the lazy dog by the river again"),
        (8, "clean and short"),
    ]
    placed = corpus_pipeline.run(spark, folder(rows))
    # 2 stands for the empty texts, 4 for its copies, 5 for its near copy; 7 holds the benchmark item.
    assert {r.doc_id for r in placed.select("doc_id").collect()} == {None, 2, 4, 5, 8}


def test_columns_stay_until_packing(spark, folder):
    path = folder([(1, "one text"), (2, "another text")])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == [c.split()[0] for c in DOCUMENT.split(", ")]


def test_no_documents(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).count() == 0
