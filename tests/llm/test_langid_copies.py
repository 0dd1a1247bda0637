"""Many copies of one text teach no more than the text once."""

import numpy as np
from pyspark.sql import functions as F

from linenet.llm import langid


def test_copies_count_once(documents):
    docs = documents.where("lang is not null and text rlike '[^\\\\s]'").select("text", "lang")
    want = langid.fit(docs.distinct(), rows_each=20)
    # The copies have the least hash of their language.
    hot = docs.orderBy(F.xxhash64("text")).limit(1)
    got = langid.fit(docs.union(hot.crossJoin(docs.sparkSession.range(1000)).select("text", "lang")).repartition(7), rows_each=20)
    assert got.classes == want.classes
    np.testing.assert_allclose(got.weights, want.weights, atol=1e-5)
