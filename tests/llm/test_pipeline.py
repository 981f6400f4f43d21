"""The pipeline's stages against brute-force versions of what each must keep."""

import re

from odd import documents
from test_documents import base_measures, brute_classes, expected_ids

import corpus_pipeline
from starfeed.workspace import written

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near duplicates", "secret scan", "packing"]

    quality = written(stages["quality rules"](spark, docs, SF_DIR), "quality")
    kept = {r["doc_id"]: r["text"] for r in quality.collect()}
    passing = {r["doc_id"] for r in docs.collect() if not base_measures(r["text"])[-1]}
    assert set(kept) <= passing and len(kept) >= 0.9 * len(passing)

    unique = written(stages["near duplicates"](spark, quality, SF_DIR), "unique")
    rows = list(kept.items())
    assert {r["doc_id"] for r in unique.collect()} == {c for c, _ in brute_classes(rows).values()}

    scanned = written(stages["secret scan"](spark, unique, SF_DIR), "scanned")
    before = {r["doc_id"]: r["text"] for r in unique.collect()}
    masked = re.compile(r'AKIA[0-9A-Z]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = ")[0-9a-f]{40}')
    after = {r["doc_id"]: r["text"] for r in scanned.collect()}
    assert after == {i: masked.sub("[SECRET]", t) for i, t in before.items()}

    pieces = stages["packing"](spark, scanned, SF_DIR).collect()
    assert sum(r["length"] for r in pieces) == sum(len(expected_ids(t)) for t in after.values())
    for frame in (quality, unique, scanned):
        assert frame.columns == docs.columns


def test_stages_take_odd_rows_and_empty_tables(spark):
    for rows in (documents(spark), documents(spark, [])):
        rows = rows.withColumnRenamed("n_words", "n_chars")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, rows, SF_DIR)
            assert kept.columns == rows.columns
            kept.count()
        pieces = corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR).collect()
        assert sum(r["start"] == 0 for r in pieces) == rows.count()
