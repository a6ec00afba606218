"""What the driver holds and plans: the training sample as two bytes a subword, a star round in two plans."""

import tracemalloc

import numpy as np

from riskloom.llm import langid, linking


def test_training_holds_two_bytes_a_subword():
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(97, 123, 20_000))) for _ in range(60)]
    total = sum(len(b) for t in texts for b in langid.subwords(t))
    tracemalloc.start()
    langid.train(texts, ["xx"] * len(texts))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Besides the buckets: the model's own tables, and one text at a time.
    assert most < 2 * total + (16 << 20) < 8 * total


def test_every_bucket_has_its_number():
    assert np.iinfo(langid.BUCKET_TYPE).max == (1 << langid.BUCKET_BITS) - 1


def test_a_star_round_is_planned_in_two_parts(spark):
    links = spark.createDataFrame([(i, i - 1) for i in range(1, 40)], "u long, v long")
    plan = linking._star(links)._jdf.queryExecution().executedPlan().toString()
    # The second half reads the written first half; with that half inside, the plan has 27 exchanges.
    assert plan.count("Exchange hashpartitioning") <= 6
