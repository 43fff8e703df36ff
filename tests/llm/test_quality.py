"""The discriminant against its definition, and held-out accuracy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from waferscope.llm import quality
from waferscope.llm.registry import crc_fold, op12_quality, table

ODD = ["", " ", "\n", "a", "!!!", "😀" * 50, "퟿ ￿ \U0010ffff", "WORD " * 400, "| a | b |\n" * 60, "x" * 300_000, "1 2 3", "a b\x85c"]


def test_statistics_of_any_text():
    for text in ODD:
        values = quality.statistics(text)
        assert len(values) == len(quality.STATISTICS) and np.isfinite(values).all()
    assert quality.statistics("") == [0.0] * len(quality.STATISTICS)
    named = dict(zip(quality.STATISTICS, quality.statistics("Go go go go! 12\n12"), strict=True))
    share = lambda part, whole: np.arcsin(np.sqrt(part / whole))
    assert named["words"] == np.log1p(6) and named["chars"] == np.log1p(18)
    assert named["capital"] == share(1, 8) and named["digit"] == share(4, 18) and named["loud"] == share(1, 18)
    assert named["distinct_words"] == share(4, 6) and named["commonest_word"] == share(2, 6) and named["repeated_word"] == share(2, 6)
    assert named["word_run"] == np.log1p(2) and named["line_length"] == np.log1p(9)


def drawn(rng: np.random.Generator, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Two classes with the same mean that only a quadratic discriminant tells apart."""
    size = len(quality.STATISTICS)
    label = (rng.random(rows) < 0.7).astype(int)
    x = rng.normal(size=(rows, size)) * np.where(label, 0.5, 2.0)[:, None]
    return x + 3, label


def test_model_is_the_regularised_discriminant(spark):
    rng = np.random.default_rng(4)
    x, label = drawn(rng, 3_000)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    measured = spark.createDataFrame(rows, "doc_id long, x array<double>")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(label)] + [(5, None), (6, 7), (None, 1)], "doc_id long, quality int")
    model = quality.train(measured, labels.repartition(5))
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    pooled = sum((label == k).mean() * np.cov(z[label == k].T, bias=True) for k in (0, 1))
    densities = []
    for k in (0, 1):
        own = z[label == k]
        covariance = quality.shrunk(np.cov(own.T, bias=True), pooled, len(own), 0.05)
        away = z - own.mean(axis=0)
        densities.append(-0.5 * np.linalg.slogdet(covariance)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(covariance), away))
    assert np.allclose(np.sinh(model.difference(x)), densities[1] - densities[0], rtol=1e-6, atol=1e-6)
    assert ((model.score(x) >= 0.5) == label).mean() > 0.99
    found = {r.doc_id: r.score for r in quality.with_quality(measured, model).collect()}
    assert np.allclose([found[i] for i in range(len(x))], model.score(x))


def test_shrunk_covariances_can_be_factored():
    rng = np.random.default_rng(1)
    size = len(quality.STATISTICS)
    for rows in (1, 2, 10, 1_000):
        own = rng.normal(size=(rows, size))
        own[:, 3] = 0
        covariance = np.cov(own.T, bias=True) if rows > 1 else np.zeros((size, size))
        made = quality.shrunk(covariance, np.eye(size), rows, 0.05)
        assert np.linalg.eigvalsh(made).min() > 0


@pytest.mark.parametrize(("labels", "score"), [([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)])
def test_without_two_classes_every_score_is_the_share(spark, labels, score):
    docs = spark.createDataFrame([(1, "a"), (2, None), (2, ""), (None, "b")], "doc_id long, text string")
    measured = quality.measure(docs)
    model = quality.train(measured, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert [r.score for r in quality.with_quality(measured, model).collect()] == [score] * 4


def test_odd_rows_extra_columns_and_no_rows(spark):
    texts = [None, *ODD, "same", "same"]
    df = spark.createDataFrame([(n // 2, t, "kept", 1.0) for n, t in enumerate(texts)], "doc_id int, text string, x string, score double")
    labels = spark.createDataFrame([(n, n % 2) for n in range(4)] * 2, "doc_id int, quality int")
    measured = quality.measure(df)
    found = quality.with_quality(measured, quality.train(measured, labels)).collect()
    assert sorted(r.doc_id for r in found) == [n // 2 for n in range(len(texts))] and all(0 <= r.score <= 1 for r in found)
    assert quality.with_quality(quality.measure(df.limit(0)), quality.train(measured, labels)).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    found = op12_quality(spark, folder)
    assert found.count() == table(spark, folder, "documents").count()
    known = found.where("held_out").join(table(spark, folder, "labels"), "doc_id")
    right = F.avg((F.col("predicted") == F.col("quality")).cast("int"))
    by_class = {r.quality: r.right for r in known.groupBy("quality").agg(right.alias("right")).collect()}
    assert by_class[1] >= 0.98 and by_class[0] >= 0.95
    fold = F.coalesce(crc_fold(3) == 1, F.lit(False))
    assert found.where(F.col("held_out") != fold).count() == 0
