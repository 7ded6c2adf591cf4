"""The index of examples in parts: what the driver holds of it, and that the parts are searched as one."""

import pickle
import random
import tracemalloc

import numpy as np

from cratewise.llm import toxicity
from cratewise.llm.toxicity import BlockMaxIndex, fit, score_toxicity

WORDS, EACH = 2_000, 300


def examples(spark, n):
    """Every tenth with a telling word; texts without words; an id that comes twice."""
    dice, words = random.Random(5), [f"w{i}" for i in range(WORDS)]
    texts = [(i, " ".join(dice.choices(words, weights=range(1, WORDS + 1), k=EACH)) + (" vile" if i % 10 == 0 else "")) for i in range(n)]
    texts += [(n, "..."), (n + 1, None), (n + 2, "w1 w2 w3"), (n + 2, "w1 w2 w4 vile")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    return df, df.select("doc_id").distinct().selectExpr("doc_id", "int(doc_id % 10 = 0) toxic")


def test_the_driver_holds_a_part_of_the_postings(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "ENTRIES_PER_PART", 40_000, raising=False)
    docs, labels = examples(spark, 3_000)
    fit(*(x.limit(100) for x in (docs, labels)))  # what is loaded but once
    tracemalloc.start()
    try:
        model = fit(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert WORDS - 10 < len(model.vocabulary) <= WORDS + 1
    # Some 240 different words in each of 2,400 examples; a posting has 8 bytes.
    assert peak < 8 * 2_400 * 240, peak


def test_scores_do_not_depend_on_the_parts(spark, monkeypatch):
    docs, labels = examples(spark, 300)
    found = []
    for entries in (1_000_000, 10_000, 3_000):
        monkeypatch.setattr(toxicity, "ENTRIES_PER_PART", entries)
        model = fit(docs, labels)
        found.append((len(model.parts), sorted(map(tuple, score_toxicity(docs, model).collect()), key=repr)))
    assert found[0][0] == 1 and found[1][0] > 3 and found[2][0] > 10
    assert found[0][1] == found[1][1] == found[2][1]
    assert any(x[3] == 1 for x in found[0][1])


def test_parts_are_searched_as_one_index():
    rng = np.random.default_rng(2)
    share = 0.9 / np.arange(1, 301)
    dense = np.where(rng.random((500, 300)) < share, rng.random((500, 300)), 0).astype(np.float32)
    dense[:, 0] += 0.1
    vectors = [(np.flatnonzero(x), x[np.flatnonzero(x)]) for x in dense]
    whole = BlockMaxIndex(list(range(500)), np.zeros(500, dtype=int), vectors, 300)
    ordered = dense[whole.ids]
    parts = []
    for low, high in ((0, 1), (1, 40), (40, 41), (41, 300)):
        term, row = np.nonzero(ordered[:, low:high].T)
        part = toxicity.Part(np.bincount(term, minlength=high - low), row, ordered[row, term + low], 500)
        parts.append(pickle.loads(pickle.dumps(part)))
    index = BlockMaxIndex.without_parts(whole.ids, whole.toxic)
    index.fill(parts)
    for other in (index, pickle.loads(pickle.dumps(index))):
        assert (other.dense == whole.dense).all() and (other.top == whole.top).all() and (other.start == whole.start).all()
        for term, weight in vectors[:100]:
            assert other.nearest(term, weight, 15, [3]) == whole.nearest(term, weight, 15, [3])
