"""The stages of the corpus pipeline, each against a plain version on its own input."""
import os
import subprocess
import sys

import corpus_pipeline
from sigspark.llm import quality, secrets
from sigspark.llm.common import table

from .test_dedup import exact_by_hand, near_by_hand
from .test_packing import check_places
from .test_secrets import base_by_hand

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs)
    rows = [d.collect() for d in seen]
    for stage_rows in seen[1:-1]:
        assert stage_rows.columns == columns
    texts = [[(r.doc_id, r.text) for r in part] for part in rows[:-1]]
    # quality: those predicted 1 by a model of the same training
    model = quality.train(seen[0], table(spark, SF, "labels"))
    good = {r.doc_id for r in quality.scores(seen[0], model).filter("predicted = 1").collect()}
    assert sorted(rows[1]) == sorted(r for r in rows[0] if r.doc_id in good)
    # exact and near copies
    kept = {i for i, keep, _, _ in exact_by_hand(texts[1]) if i == keep}
    assert sorted(rows[2]) == sorted(r for r in rows[1] if r.doc_id in kept)
    kept = {i for i, _, _, own in near_by_hand(texts[2], 5) if own}
    assert sorted(rows[3]) == sorted(r for r in rows[2] if r.doc_id in kept)
    # masks: all documents stay, no base span is left, clean ones are untouched
    assert {r.doc_id for r in rows[4]} == {r.doc_id for r in rows[3]}
    before = {r.doc_id: r for r in rows[3]}
    for r in rows[4]:
        assert not base_by_hand(r.text)
        if not base_by_hand(before[r.doc_id].text) and secrets.MASK not in r.text:
            assert r == before[r.doc_id]
    # packing: every document, whole
    check_places(rows[5])
    assert {r.doc_id for r in rows[5]} == {r.doc_id for r in rows[4]}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns[:2] == ["doc_id", "piece"]


def test_registered_and_separable():
    """All queries of the subpackage are registered; without it the other queries still are."""
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    code = "import sys; sys.modules['sigspark.llm'] = None; import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries()); e.oracle_sql()"
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
