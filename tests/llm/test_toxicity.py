import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from threadsift.llm import toxicity

LARGE = "/root/testdata/sf0.1"


def test_trees_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(int)
    trees = toxicity.Trees.fit(x[:2000], y[:2000], trees=40)
    raw = trees.raw(x[2000:])
    assert ((raw > 0) == (y[2000:] == 1)).mean() > 0.97
    points, values = toxicity.isotonic(raw, y[2000:])
    assert (np.diff(points) >= 0).all() and (np.diff(values) >= -1e-12).all() and 0 <= values[0] <= values[-1] <= 1


def test_isotonic_pools_violators_and_ties():
    points, values = toxicity.isotonic(np.array([1.0, 2.0, 3.0, 3.0, 4.0]), np.array([0, 1, 0, 0, 1]))
    assert np.allclose(np.interp([1, 2, 3, 4], points, values), [0, 1 / 3, 1 / 3, 1])


def test_features():
    words = toxicity.Words(frozenset({"idiot"}), frozenset({"lowei"}), frozenset({"hmpf"}))
    texts = pa.array(["You IDIOT, you 1d1ot! i.d.i.o.t? Loweischaft hmpf", "", None, "plain words here"])
    rows = [dict(zip(toxicity.FEATURES, r, strict=True)) for r in toxicity.features(texts, words)]
    assert (rows[0]["lexicon_count"], rows[0]["hidden_count"], rows[0]["beginning_count"], rows[0]["wider_count"]) == (1, 2, 1, 1)
    assert rows[0]["near_second_rate"] == 3 / 7 and rows[0]["second_rate"] == 2 / 7 and rows[0]["capital_words"] == 1 / 7
    assert rows[0]["exclamations"] > 0 and rows[0]["obfuscated_words"] == 2 / 7
    assert set(rows[1].values()) == set(rows[2].values()) == {0.0} and rows[3]["lexicon_rate"] == 0


def labels_of(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, toxic int, text int")


def test_odd_rows(spark, docs):
    rows = [(i, f"you are an idiot number {i}" if i % 2 else f"a friendly text number {i} with words") for i in range(200)]
    rows += [(None, "idiot"), (500, None), (501, ""), (502, "idiot " * 50_000), rows[3], rows[3]]
    marked = [(i, i % 2) for i in range(200)] + [(3, 0), (None, 1), (500, None), (77_777, 1)]
    model = toxicity.train(docs(*rows), labels_of(spark, marked))
    scored = toxicity.score(docs(*rows), model).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    by_id = {r.doc_id: r.score for r in scored}
    held = [i for i in range(200) if not spark.range(1).select(toxicity.learnable(F.lit(i))).first()[0]]
    assert all((by_id[i] >= 0.7) == bool(i % 2) for i in held)
    wide = toxicity.scored_rows(docs(*rows), model)
    assert wide.columns == [*docs().columns, "_score"] and wide.count() == len(rows)


def test_without_labels(spark, docs):
    for marked, want in (([], 0.0), ([(i, 1) for i in range(20)], 1.0)):
        model = toxicity.train(docs(*((i, "text") for i in range(20))), labels_of(spark, marked))
        assert {r.score for r in toxicity.score(docs((1, "x"), (2, None)), model).collect()} == {want}
    assert toxicity.score(docs(), model).collect() == []


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{LARGE}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    rows = scored.join(labels.filter(~toxicity.learnable(F.col("doc_id"))), "doc_id").collect()
    toxic, flagged = [r.toxic == 1 for r in rows], [r.score >= toxicity.REJECT_SCORE for r in rows]
    hits = sum(a and b for a, b in zip(toxic, flagged, strict=True))
    assert len(rows) > 1000 and hits / sum(flagged) > 0.97 and hits / sum(toxic) > 0.85
