"""Trained models: accuracy on held-out rows, identities, edge cases."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from carelattice.llm import quality_model, toxicity
from carelattice.llm.frames import held_out, training_rows
from tests.llm.conftest import SCHEMA

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def known(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "n_chars")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return docs.join(labels.select("doc_id"), "doc_id", "left_semi").repartition(8), labels


def judged(known, module, label):
    docs, labels = known
    model = module.train(docs, labels.where(~held_out(5)), label)
    rows = module.scored(docs, model).join(labels.where(held_out(5)), "doc_id").toPandas()
    return rows, model


def test_toxicity(known):
    rows, (at, weight, _) = judged(known, toxicity, "toxic")
    toxic = rows[rows.toxic == 1]
    assert (rows[rows.toxic == 0].predicted == 0).mean() > 0.99
    assert (toxic.predicted == 1).mean() > 0.5  # many toxic labels have no toxic word in any language
    assert rows.score.between(0, 1).all() and len(at) < 0.02 * 2**toxicity.BITS


def test_quality(known):
    rows, _ = judged(known, quality_model, "quality")
    assert (rows[rows.quality == 1].predicted == 1).mean() > 0.99
    assert (rows[rows.quality == 0].predicted == 0).mean() > 0.9


@pytest.mark.parametrize("module", [toxicity, quality_model])
def test_edges(spark, frame, documents, empty, clashing, module):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i, _ in documents if i is not None] + [(None, 1, 1), (9003, None, None)],
                                   "doc_id bigint, toxic int, quality int")
    model = module.train(frame, labels)
    rows = module.scored(frame, model).collect()
    assert len(rows) == len(documents) and all(0 <= r.score <= 1 for r in rows)
    blank = {r.score for r in rows if r.doc_id in (9000, 9001)}
    assert len(blank) == 1
    assert module.scored(empty, model).count() == 0
    assert module.scored(clashing, model).first()["N_Words"] == "N_Words"
    none = module.train(frame, labels.limit(0))
    assert {r.score for r in module.scored(frame, none).collect()} == {0.5}
    assert module.train(spark.createDataFrame([], SCHEMA), labels) is not None


def test_sum_of_squares_identity():
    machine = quality_model.Machine(3)
    owner, slot, value = np.zeros(6, int), np.array([1, 5, 9, 70, 71, 72]), np.arange(1, 7) / 7.0
    rows = machine.v[slot]
    pairs = sum(value[i] * value[j] * rows[i, 1:] @ rows[j, 1:] for i, j in itertools.combinations(range(6), 2))
    assert machine.raw(owner, slot, value, 1)[0][0] == pytest.approx(rows[:, 0] @ value + pairs)


def test_training_updates_follow_ftrl():
    """Against the published per-coordinate update, coordinate by coordinate in a plain loop."""
    texts = ["bad words here", "fine words", "bad bad here now", "", "fine day and fine words"]
    label = np.array([1.0, 0.0, 1.0, 0.0, 0.0])
    doc, slot, _ = toxicity.features(pa.array(texts))
    z, n = {}, {}

    def weight(i):
        penalty = 0.0 if i == "bias" else toxicity.L1
        at = z.get(i, 0.0)
        if abs(at) <= penalty:
            return 0.0
        return -(at - np.sign(at) * penalty) / ((toxicity.BETA + n.get(i, 0.0) ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for d, y in enumerate(label):
            used = [*slot[doc == d].tolist(), "bias"]
            now = {i: weight(i) for i in used}
            g = 1 / (1 + np.exp(-sum(now.values()))) - y
            for i in used:
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * now[i]
                n[i] = n.get(i, 0.0) + g * g
    w, bias = toxicity.ftrl(doc, slot, label)
    assert w.shape == (2**toxicity.BITS,) and bias == pytest.approx(weight("bias"))
    known = np.unique(slot)
    assert w[known] == pytest.approx([weight(i) for i in known.tolist()]) and np.count_nonzero(w) == np.count_nonzero(w[known])


def test_an_id_with_very_many_rows_keeps_the_bound(spark):
    hot = [(1, f"text number {i}") for i in range(3000)] + [(1, "the same")] * 500 + [(i, f"other {i}") for i in range(2, 80)]
    docs = spark.createDataFrame(hot, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(1, 1)] * 300 + [(1, 0)], "doc_id bigint, toxic int")
    got = training_rows(docs, labels, "toxic", 51).collect()
    assert len(got) == 51 and len({r["__place"] for r in got}) == 51
    everything = training_rows(docs, labels, "toxic", 100_000)
    assert everything.count() == 2 * 3001 + 78  # id 1 has two labels; equal rows count once
    assert training_rows(docs, labels.limit(0), "toxic", 51).count() == 0


def test_the_stated_length_moves_a_score(spark):
    rows = [(i, f"word{i % 7} and some more words here {i}", 10 if i % 2 else 5000) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, quality int")
    model = quality_model.train(docs, labels)
    probe = spark.createDataFrame(
        [(1, "word1 and words", "10"), (2, "word1 and words", "5000"), (3, "word1 and words", None), (4, "word1 and words", "15"),
         (5, "word1 and words", "many"), (6, "word1 and words", "-1"), (7, None, None)], "doc_id bigint, text string, n_chars string")
    scores = {r.doc_id: r.score for r in quality_model.scored(probe, model).collect()}
    assert scores[1] > 0.6 > 0.4 > scores[2]
    assert scores[3] == scores[4] == scores[5] == scores[6]
    plain = quality_model.scored(probe.drop("n_chars"), model).where("doc_id = 3").first()
    assert plain.score == scores[3] and quality_model.scored(probe, model).columns == ["doc_id", "n_chars", "score", "predicted"]
