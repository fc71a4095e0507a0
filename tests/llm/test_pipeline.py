import corpus_pipeline
from corvane.llm.quality import quality_scores

from tests.llm.test_minhash import brute as near
from tests.llm.test_substring import brute as repeats

SF = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {}
    before = {r.doc_id: r for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        rows[name] = {r.doc_id: r for r in docs.collect()}
        if i < 4:
            assert docs.columns == columns
    stages = list(rows.values())
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality_scores(spark.read.parquet(f"{SF}/documents.parquet"), labels).where("predicted = 1").collect()}
    assert set(stages[0]) == good and all(stages[0][i] == before[i] for i in good)

    kept = {i for i, (_, _, k) in near([(i, r.text) for i, r in stages[0].items()], 80).items() if k}
    assert set(stages[1]) == kept and len(kept) < len(good)

    want = {i: (gone, sha) for i, _, gone, sha in repeats([(i, r.text) for i, r in stages[1].items()])}
    assert set(stages[2]) == kept
    for i, r in stages[2].items():
        if not want[i][0]:
            assert r == stages[1][i]
        else:
            assert len(stages[1][i].text.split()) - len(r.text.split()) == want[i][0] and r.n_chars == len(r.text)

    items = [f" {' '.join(b.text.lower().split())} " for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i, r in stages[2].items() if any(t in f" {' '.join(r.text.lower().split())} " for t in items)}
    assert leaked and set(stages[3]) == kept - leaked

    assert set(stages[4]) <= set(stages[3])
    for i, r in stages[4].items():
        assert tuple(r)[: len(columns)] == tuple(stages[3][i]) and 0 < r.taken <= 3 * r.size


def test_run(spark):
    taken = corpus_pipeline.run(spark, SF)
    assert taken.count() > 50 and taken.columns[-4:] == ["size", "source_size", "target", "taken"]
