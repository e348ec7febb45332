import numpy as np

import corpus_pipeline
from quaestor.llm import neighbours, registry


def _frame(spark, x, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], [float(v) for v in r], 0) for i, r in enumerate(x)],
                                 "vec_id long, embedding array<float>, label int")


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 32)).astype(np.float32)
    x[::7] *= 3
    got = neighbours.search(_frame(spark, x), "id % 50 = 0").toPandas()
    full, hit = x.astype(np.float64) @ x.astype(np.float64).T, 0
    np.fill_diagonal(full, -np.inf)
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, 21)) and np.allclose(g.score, full[q, g.vec_id], atol=1e-9)
        hit += len(set(g.vec_id) & set(np.argsort(-full[q], kind="stable")[:20]))
    assert got.query_id.nunique() == 30 and hit >= 0.9 * 600


def test_copies_tie_to_smaller_ids_and_odd_vectors_stay_out(spark):
    x = np.vstack([np.tile([1.0, 0.0], (9000, 1)), [[0.0, 1.0], [0.5, 0.5]]])
    rows = _frame(spark, x)
    odd = spark.createDataFrame([(20_000, None, 0), (20_020, [0.0, 0.0], 0), (20_040, [1.0, None], 0),
                                 (20_060, [float("nan"), 1.0], 0), (20_080, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0),
                                 (0, [1.0, 0.0], 0)], rows.schema)
    got = neighbours.search(rows.unionAll(odd), "id in (0, 20, 8000, 20000, 20020, 20040, 20060, 20080)", k=5).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by == {0: [1, 2, 3, 4, 5], 20: [0, 1, 2, 3, 4], 8000: [0, 1, 2, 3, 4]}


def test_fewer_candidates_than_asked(spark):
    got = neighbours.search(_frame(spark, [[1, 0], [-1, 0], [0, 1]]), "id % 2 = 0").collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 2), (0, 2, 1), (2, 1, 0), (2, 2, 1)]
    assert neighbours.search(_frame(spark, np.zeros((3, 2))), "id = 0").count() == 0


def test_pipeline_stages_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, left, sf).cache()
        assert after.columns == docs.columns and 0 < after.count() <= left.count()
        left = after
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in left.collect()}


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
