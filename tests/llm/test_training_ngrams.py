"""What of the toxicity sample comes to the driver."""

from __future__ import annotations

import numpy as np

from loglake.llm import toxicity


def test_only_ngrams_of_the_fit_come_to_the_driver(spark, monkeypatch):
    """The fit is handed its own n-grams only, and the rows of all texts."""
    texts = [(i, f"{'vile nasty words' if i % 3 == 0 else 'calm kind words'} number {chr(97 + i % 26) * 5}") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    seen, fit = [], toxicity.fit

    def spy(pieces, toxic, weight):
        seen.append(np.unique(np.concatenate([bucket for _, bucket, _ in pieces])))
        return fit(pieces, toxic, weight)

    monkeypatch.setattr(toxicity, "fit", spy)
    model = toxicity.train(docs, labels)
    assert len(model.buckets) and seen[0].tolist() == np.sort(model.buckets).tolist()
