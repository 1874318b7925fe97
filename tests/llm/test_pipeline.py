
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_decontaminate, test_simhash, test_substring

SF = "/root/testdata/sf0.001"


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def test_language_id_keeps_rows_as_they_are(spark):
    docs = docs_of(spark)
    kept = rows_of(corpus_pipeline.language_id(spark, docs, SF))
    assert set(kept) <= set(rows_of(docs)) and len(kept) >= 0.97 * docs.count()
    assert all(any(c.isalpha() for c in r[1]) for r in kept)


def test_near_dedup_keeps_one_of_each_component(spark):
    docs = docs_of(spark)
    kept = rows_of(corpus_pipeline.simhash_near_dedup(spark, docs, SF))
    classes = test_simhash.plain_classes([r[:2] for r in rows_of(docs)])
    assert [r[0] for r in kept] == sorted({c for _, _, c in classes}, key=str) and set(kept) <= set(rows_of(docs))


def test_substring_dedup_cuts_what_recurs(spark):
    docs = docs_of(spark)
    kept = {r[0]: r for r in rows_of(corpus_pipeline.substring_dedup(spark, docs, SF))}
    rows = rows_of(docs)
    changed = 0
    for (doc, n, removed, words), row in zip(test_substring.plain([r[:2] for r in rows], 35), rows):
        assert kept[doc][2:4] == row[2:4]
        if removed:
            changed += 1
            assert " ".join(test_substring.spaced(kept[doc][1])) == words and kept[doc][4] == len(kept[doc][1])
        else:
            assert kept[doc] == row
    assert changed > 3


def test_decontamination_drops_contaminated_documents_only(spark):
    docs = docs_of(spark)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = rows_of(docs)
    bad = {p[0] for p in test_decontaminate.plain([r[:2] for r in rows], items, 13) if p[-1]}
    kept = rows_of(corpus_pipeline.benchmark_decontamination(spark, docs, SF))
    assert bad and kept == [r for r in rows if r[0] not in bad]


@pytest.mark.parametrize("number", range(5))
def test_stages_take_empty_tables_and_extra_columns(spark, number):
    _, stage = corpus_pipeline.STAGES[number]
    extra = {"key": F.lit(1), "row": F.lit("r"), "hits": F.lit(2), "cut": F.lit("c"), "k": F.lit(3)}
    docs = docs_of(spark).limit(30).withColumns(extra)
    last = number == len(corpus_pipeline.STAGES) - 1
    for table in (docs, docs.limit(0), docs.withColumn("text", F.lit(None).cast("string"))):
        found = stage(spark, table, SF)
        assert last or found.columns == docs.columns
        assert found.count() <= 5000


def test_whole_run(spark):
    found = corpus_pipeline.run(spark, SF)
    rows = found.collect()
    names = {r.doc_id for r in docs_of(spark).collect()}
    assert rows and {r.doc_id for r in rows} <= names and len({r.doc_id for r in rows}) > 0.5 * len(names)
    assert all(len(r.ids) == 4 * r.length for r in rows)
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 2048
