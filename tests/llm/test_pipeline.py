from pathlib import Path

import corpus_pipeline as P
from galeframe.llm.bpe import round_trip
from galeframe.llm.decontaminate import find_leaks
from galeframe.llm.near_dup import near_duplicates
from galeframe.llm.quality_classifier import fit_quality, quality_scores
from galeframe.llm.quality_rules import quality_rules

SF = "/root/testdata/sf0.001"


def test_each_stage_does_what_its_operator_decides(spark):
    assert Path(SF).exists() and [n for n, _ in P.STAGES] == ["quality_rules", "quality_classifier", "near_dedup", "decontamination", "bpe_encoding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    one = P.quality_rules(spark, docs, SF).cache()
    assert ids(one) == ids(quality_rules(docs).filter("kept")) and one.columns == docs.columns
    two = P.quality_classifier(spark, one, SF).cache()
    assert ids(two) == ids(quality_scores(one, fit_quality(docs, labels)).filter("predicted = 1"))
    three = P.near_dedup(spark, two, SF).cache()
    assert ids(three) == ids(near_duplicates(two).filter("kept"))
    four = P.decontamination(spark, three, SF).cache()
    leaked = set(ids(find_leaks(three, bench)))
    assert ids(four) == [i for i in ids(three) if i not in leaked] and four.columns == docs.columns
    want = sorted(map(tuple, round_trip(four, __import__("public_tokenizers").path(P.VOCABULARY)).collect()))
    assert sorted(map(tuple, P.bpe_encoding(spark, four, SF).collect())) == want == sorted(map(tuple, P.run(spark, SF).collect()))
