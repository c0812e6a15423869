from pyspark.sql import functions as F

import corpus_pipeline

from .tinydocs import documents, sentence


def test_near_copies_with_repeated_and_missing_ids(spark):
    one, two, three = (sentence(i, 60) for i in (1, 200, 500))
    rows = [(7, one), (7, two), (8, one + " end"), (None, three), (None, three + " end"), (9, two + " end")]
    left = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), "").select("doc_id", F.left("text", F.lit(20)).alias("t")).collect()
    assert sorted((str(r.doc_id), r.t) for r in left) == sorted([("7", one[:20]), ("7", two[:20]), ("None", three[:20])])
