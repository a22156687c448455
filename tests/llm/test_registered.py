"""The registered queries over a small table, and the pipeline a stage at a time."""

import corpus_pipeline
import pytest
from compare import connect, differences

import __spark_entry__ as entry
from parcelflow.llm import queries
from parcelflow.llm.kept import kept

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_sql(spark, name):
    mine = queries.QUERIES[name](spark, SF).toPandas()
    theirs = connect(SF).execute(queries.ORACLES[name]).df()
    # Whole numbers with nulls are floats in one engine's frames.
    theirs = theirs.astype({c: "float64" for c in theirs if str(theirs[c].dtype) == "Int64"})
    assert len(mine) > 0
    assert differences(mine[list(theirs.columns)], theirs) == []


def test_all_are_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"
    ]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = kept(stage(spark, docs, SF), name)
        assert after.columns == columns
        gone = docs.join(after, "doc_id", "left_anti")
        if name == "quality_rules":
            left = gone.join(labels, "doc_id").filter("quality = 0").count()
            bad = docs.join(labels, "doc_id").filter("quality = 0").count()
            assert bad > 0 and left >= 0.95 * bad
        elif name == "line_dedup":
            assert gone.count() == 0
        else:
            assert 0 < after.count() < docs.count()
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert set(pieces.doc_id) == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert pieces.groupby("doc_id").length.sum().equals(pieces.groupby("doc_id").doc_tokens.first())
    assert len(corpus_pipeline.run(spark, SF).toPandas()) == len(pieces)


def test_near_copies_from_four_fifths_leave_the_pipeline(spark):
    table = []
    for n, count in enumerate((50, 52, 55, 58, 45)):  # one word changed: 0.80 to 0.83, then 0.78
        base = [f"w{n}_{i}" for i in range(count)]
        copy = list(base)
        copy[count // 2] = "changed"
        table += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(copy))]
    docs = spark.createDataFrame(table, "doc_id bigint, text string")
    after = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted(r["doc_id"] for r in after.collect()) == [0, 2, 4, 6, 8, 9]
