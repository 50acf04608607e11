from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from orderflow.llm import quality
from orderflow.llm.common import in_fold, table
from tests.llm.conftest import DOCUMENTS


def test_isotonic_is_the_closest_ascending_fit():
    values, weights = np.array([1.0, 3.0, 2.0, 2.0, 5.0, 4.0]), np.array([1.0, 1, 1, 2, 1, 1])
    assert quality.isotonic(values, weights).tolist() == [1, 2.25, 2.25, 2.25, 4.5, 4.5]


def test_waves_approximate_a_gaussian_kernel():
    rows = np.random.default_rng(0).normal(size=(40, len(quality.STATISTICS)))
    mean, scale = np.zeros(rows.shape[1]), np.ones(rows.shape[1])
    waves = quality.design(rows, mean, scale)[:, : quality.FEATURES]
    distance = ((rows[:, None] - rows[None]) ** 2).sum(axis=2)
    kernel = np.exp(-distance / (2 * quality.WIDTH**2))
    assert np.abs(waves @ waves.T - kernel).max() < 0.3


def test_normal_equations_agree_with_one_solve(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(quality.STATISTICS)))
    y = (x[:, 0] + 0.2 * x[:, 3] > 0).astype(float)
    rows = [(i, x[i].tolist(), float(y[i])) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, statistics array<double>, label double")
    model = quality.fit(frame.drop("label").repartition(7), frame.select("doc_id", "label"))
    design = quality.design(x, x.mean(axis=0), x.std(axis=0))
    weights = np.linalg.solve(
        design.T @ design + quality.RIDGE * np.eye(design.shape[1]), design.T @ y
    )
    assert np.allclose(model.weights, weights, atol=1e-6)
    score = model.score(x)
    assert ((score >= 0) & (score <= 1)).all()
    order = np.argsort(design @ weights)
    assert (np.diff(score[order]) >= -1e-12).all()


def _text(rng, junk):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(80)]
    if junk:
        words = [w + "###" for w in words] if rng.random() < 0.5 else [words[0]] * 80
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(2)
    return [(i, _text(rng, i % 4 == 0), int(i % 4 != 0)) for i in range(400)]


def test_held_out_accuracy_and_no_look_at_held_out_labels(spark, documents, labelled):
    docs = documents(*((i, t) for i, t, _ in labelled))
    held = in_fold(F.col("doc_id"), 5, 0)
    labels = spark.createDataFrame([(i, q) for i, _, q in labelled], "doc_id bigint, label int")
    rows = quality.score_documents(docs, labels, held).collect()
    truth = {i: q for i, _, q in labelled}
    right = [(r["score"] >= 0.3) == bool(truth[r["doc_id"]]) for r in rows if r["held_out"]]
    assert len(right) > 40 and np.mean(right) >= 0.95
    flipped = labels.withColumn("label", F.when(held, 1 - F.col("label")).otherwise(F.col("label")))
    again = quality.score_documents(docs, flipped, held).collect()
    assert {(r["doc_id"], r["score"]) for r in rows} == {(r["doc_id"], r["score"]) for r in again}


def test_nulls_repeats_long_texts_and_empty_tables(spark, documents, labelled):
    held = in_fold(F.col("doc_id"), 5, 0)
    labels = spark.createDataFrame(
        [(i, q) for i, _, q in labelled] + [(None, 1), (3, None), (3, 1)], "doc_id bigint, label int"
    )
    odd = [(1001, None), (1002, ""), (1002, ""), (None, "some text"), (1003, "word " * 300_000),
           (1004, "\n\n"), (1005, "x" * 400_000)]
    docs = documents(*((i, t) for i, t, _ in labelled), *odd)
    rows = quality.score_documents(docs, labels, held).collect()
    assert len(rows) == len(labelled) + len(odd)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1001, 1002)}) == 1
    none = labels.where("false")
    assert {r["score"] for r in quality.score_documents(docs, none, held).collect()} == {0.5}
    assert quality.score_documents(spark.createDataFrame([], DOCUMENTS), labels, held).count() == 0


def test_scores_order_held_out_documents(spark):
    """By the share of pairs in the right order: a constant score has one half."""
    sf_dir = "/root/testdata/sf0.01"
    scored = registry.queries()["op4_quality"](spark, sf_dir).toPandas()
    held = scored[scored["held_out"]].merge(table(spark, sf_dir, "labels").toPandas(), on="doc_id")
    good, bad = (held[held["quality"] == k]["score"].to_numpy() for k in (1, 0))
    assert len(good) > 20 and len(bad) > 5
    right = (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2
    assert right >= 0.95
    share = max((held["quality"] == k).mean() for k in (0, 1))
    assert (held["predicted"] == held["quality"]).mean() > share
