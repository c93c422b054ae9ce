"""What the steps on texts hold at once in a Python worker."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tabloom.llm import ngram_join


def batch(texts, words):
    rng = np.random.default_rng(1)
    column = [" ".join(map(str, rng.integers(0, 10**9, words))) for _ in range(texts)]
    return pa.RecordBatch.from_arrays([pa.array(range(texts)), pa.array(column)], names=["row_key", "text"])


def peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] >> 20
    finally:
        tracemalloc.stop()


def test_shingle_sets_take_little_beside_their_batch():
    texts = batch(200, 1000)  # 2 MB
    list(ngram_join._sets(texts))  # tables of powers
    assert peak(lambda: [None for _ in ngram_join._sets(texts)]) < 16


def test_counts_are_packed_before_they_grow():
    texts = batch(500, 5000)  # 2.5 million shingles
    run = ngram_join._count_buckets(20, 4)
    counted = list(run(iter([texts])))
    assert len(counted) > 1
    assert sum(np.frombuffer(c, np.uint32).sum() for b in counted for c in b.column(2).to_pylist()) == 500 * 4996
