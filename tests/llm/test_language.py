import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadsift.llm import language

LARGE = "/root/testdata/sf0.1"
WORDS = {"aa": "the of and that this", "bb": "der die und nicht ein", "cc": "le la et que dans", "dd": "el los que con por", "ee": "och att det som en"}


def rows_of(languages, n=30):
    rng = np.random.default_rng(1)
    return [(100 * i + k, " ".join(rng.choice(WORDS[x].split(), 30)), x) for i, x in enumerate(languages) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")


def predicted(spark, rows, model):
    return {r.doc_id: (r.lang_pred, r.score) for r in language.predict(frame(spark, rows), model).collect()}


@pytest.mark.parametrize("n", [2, 3, 4, 5, 7, 20])
def test_codewords(n):
    code = language.codewords(n)
    apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
    assert len({tuple(r) for r in code.tolist()}) == n and apart >= (1 if n < 3 else 2)
    assert ((code.min(0) == 0) & (code.max(0) == 1)).all()


def test_decoding_corrects_a_wrong_bit():
    code = language.codewords(4)
    model = language.Model(list("abcd"), code, np.zeros((1, code.shape[1])), np.ones(code.shape[1]))
    margins = np.where(code[2] == 1, 3.0, -3.0)[None, :].copy()
    margins[0, 1] *= -1
    best, score, unsure = model.decode(margins)
    assert best[0] == 2 and score[0] > 0.75 and not unsure[0]
    assert model.decode(np.zeros((1, code.shape[1])))[2][0]


@pytest.mark.parametrize("n", [2, 4, 5])
def test_languages_and_odd_texts(spark, n):
    languages = list(WORDS)[:n]
    rows = rows_of(languages)
    model = language.train(frame(spark, [*rows, (9000, "x", None), (9001, None, "aa")]))
    odd = [(8000, None, None), (8001, "", "aa"), (8002, "123 !?", "aa"), (8003, "é", "aa"), (8004, WORDS["bb"] * 100_000, None)]
    got = predicted(spark, rows + odd, model)
    assert all(got[i][0] == x for i, _, x in rows)
    assert got[8000] == got[8001] == got[8002] == ("und", 0.0) and got[8003][0] in languages and got[8004][0] == "bb"
    assert all(0 <= s <= 1 for _, s in got.values())


def test_few_languages(spark):
    rows = rows_of(["aa"])
    assert set(predicted(spark, rows, language.train(frame(spark, rows))).values()) == {("aa", 1.0)}
    assert set(predicted(spark, rows, language.train(frame(spark, []))).values()) == {("und", 0.0)}
    assert predicted(spark, [], language.train(frame(spark, rows))) == {}


def test_steps_of_a_long_text_add_up(spark):
    model = language.train(frame(spark, rows_of(["aa", "bb"])))
    data = np.frombuffer(("the und " * 400_000).encode(), np.uint8)
    whole = model.margins(data, np.array([0, len(data)]))
    assert np.allclose(whole, language._margins(model, data, np.array([0, len(data)])), atol=1e-3)
    assert pa is not None


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    found = language.predict(docs, language.train(docs.filter(~held_out)))
    rows = found.join(docs.filter(held_out).select("doc_id", "lang"), "doc_id").filter("lang is not null").collect()
    assert len(rows) > 2000 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.99
