"""One row of each group stays, with and without ids."""

import random

from docsieve.llm import ngram_join

from .test_operators import frame, prose


def test_groups_with_null_and_repeated_ids(spark):
    a, b, c = (prose(random.Random(i), 80) for i in range(3))
    near = a.rsplit(" ", 1)[0] + " changed"
    docs = [(5, a), (None, a), (None, near), (5, near), (5, a), (None, b), (None, b), (7, c), (None, ""), (None, None), (8, ""), (8, "")]
    kept = [(r.doc_id, r.text) for r in ngram_join.keep_one(frame(spark, docs)).collect()]
    long = sorted((d, t in (a, near), t == b) for d, t in kept if t and d is not None)
    assert long == [(5, True, False), (7, False, False)] and [t for d, t in kept if t and d is None] == [b]
    assert len([t for _, t in kept if not t]) == 4
