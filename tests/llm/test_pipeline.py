"""The pipeline's stages, each on its own input, against brute force."""

import importlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from threadsift.llm import toxicity
from threadsift.llm.tables import settled, table

from . import test_jaccard as jaccard_tests
from . import test_lines as line_tests
from . import test_packing as packing_tests
from . import test_winnowing as winnowing_tests

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    out = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settled(stage(spark, out[-1], SF), name).cache())
    return out


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_columns_stay(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_toxicity_stage(spark, stages):
    model = toxicity.train(stages[0], table(spark, SF, "labels"))
    clean = toxicity.score(stages[0], model).filter(F.col("score") < 0.7).select("doc_id")
    assert sorted(clean.collect()) == sorted(stages[1].select("doc_id").collect())


def test_line_dedup_stage(stages):
    rows = texts(stages[1])
    want = [(i, text) for (i, _, gone, text) in line_tests.brute_force(rows) if not gone or text.strip()]
    assert sorted((str(i), t) for i, t in texts(stages[2])) == sorted(want)
    changed = stages[2].join(stages[1].select("doc_id", F.col("text").alias("before")), "doc_id").filter("text <> before")
    assert changed.count() and changed.filter("n_chars <> length(text)").count() == 0


def test_near_duplicates_stage(stages):
    rows = texts(stages[2])
    want = {i for _, i, _, component in jaccard_tests.brute_force(rows) if i == component}
    assert sorted(i for i, _ in texts(stages[3])) == sorted(want)


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = [i for i, _, hit, _ in winnowing_tests.brute_force(texts(stages[3]), items) if not hit]
    assert sorted(str(i) for i, _ in texts(stages[4])) == sorted(clean)


def test_packing_stage(stages):
    rows = stages[5].collect()
    length = {}
    for r in rows:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    some = dict(texts(stages[4]))
    assert length.keys() == some.keys()
    assert all(length[i] == len(packing_tests.plain_ids(t or "")) + 1 for i, t in list(some.items())[:100])
    packing_tests.check_places(rows, 4096)


def test_run(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, SF).select(columns).collect()) == sorted(stages[-1].select(columns).collect())


def test_odd_documents(spark, tmp_path):
    """Through all stages: NULL, empty and repeated rows, no rows, and columns with the operators' own names."""
    wide = "doc_id long, text string, lang string, source string, n_chars long, name string, key string, block int, piece int"
    text = "a clean text that is long enough to be a line of its own and to have some shingles"
    rows = [(1, text), (1, text), (2, text), (3, None), (4, ""), (None, "no id here"), (5, "x\n\n" + text)]
    for some in (rows, []):
        docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "n", "k", 1, 2) for i, t in some], wide)
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs.columns, settled(stage(spark, docs, SF), name)
            assert docs.columns == before or name == "packing"
        got = sorted(str(r.doc_id) for r in docs.collect())
        assert got == (["1", "3", "4", "5", "None"] if some else [])


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    ours = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in ours) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
