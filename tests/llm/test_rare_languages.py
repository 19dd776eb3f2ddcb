"""Languages that a sample over all rows would miss, and more of them than a byte can number."""

import numpy as np

from tidemark.llm import language_id


def test_a_rare_language_is_learned(spark):
    rows = [(i, "ka lo mi ne ru ta", "aa") for i in range(3000)] + [(5000 + i, "den gor hum ist", "bb") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language_id.train(docs, max_rows=20)
    assert model.langs == ["aa", "bb"]
    odd = spark.createDataFrame([(1, "gor den ist hum")], "doc_id long, text string")
    assert language_id.identify(odd, model).collect()[0]["lang_pred"] == "bb"


def test_more_labels_than_a_byte_holds():
    scores = np.zeros((6, 300), np.float32)
    scores[:, 250] = 1
    assert language_id.best_path(scores, np.array([4, 2]), 2.0).tolist() == [250] * 6
