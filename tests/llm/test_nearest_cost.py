"""What a search for the nearest examples costs, and its order among equal ones."""

import time

import numpy as np

from cratewise.llm.toxicity import BlockMaxIndex

EXAMPLES, TERMS, EACH = 20_000, 2_000, 100


def sparse_vectors(seed):
    rng = np.random.default_rng(seed)
    for _ in range(EXAMPLES):
        term = np.unique(rng.integers(0, TERMS, EACH))
        yield term, np.full(len(term), 1 / np.sqrt(len(term)), dtype=np.float32)


def seconds(run, times=9):
    found = []
    for _ in range(times):
        start = time.process_time()
        run()
        found.append(time.process_time() - start)
    return min(found)


def test_a_search_costs_less_than_gathering_its_postings_one_by_one():
    vectors = list(sparse_vectors(3))
    index = BlockMaxIndex(list(range(EXAMPLES)), np.zeros(EXAMPLES, dtype=int), vectors, TERMS)
    assert index.dense.shape[1] == 0  # all words are rare
    by = np.argsort(np.concatenate([t for t, _ in vectors]), kind="stable")
    rows = np.repeat(np.arange(EXAMPLES, dtype=np.int32), [len(t) for t, _ in vectors])[by]
    weight = np.concatenate([w for _, w in vectors])[by]
    asked = np.arange(0, TERMS, 5)
    own = np.full(len(asked), 0.05, dtype=np.float32)

    def gathered():
        begin = index.start[asked]
        n = index.start[asked + 1] - begin
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(rows[at], weights=np.repeat(own, n) * weight[at], minlength=EXAMPLES)

    best = np.sort(gathered())[::-1][:15]
    assert [s for s, _ in index.nearest(asked, own, 15)] == best.tolist()
    # In turns, so that another load on the machine meets both.
    shares = [seconds(lambda: index.nearest(asked, own, 15)) / seconds(gathered) for _ in range(9)]
    assert sorted(shares)[4] < 1


def test_equal_examples_come_in_order():
    # 300 equal examples, more than a block holds, and a nearer one.
    vectors = [(np.array([0, 1]), np.array([0.6, 0.8]))] * 300 + [(np.array([1]), np.array([1.0]))]
    index = BlockMaxIndex(list(range(301)), np.zeros(301, dtype=int), vectors, 2)
    term, weight = np.array([1]), np.array([1.0])
    found = index.nearest(term, weight, 15)
    near = index.ids.index(300)
    assert found[0] == (1.0, near)
    assert [i for _, i in found[1:]] == [i for i in range(301) if i != near][:14]
