import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from anagrove.operators import hybrid
from anagrove.operators.matching import with_letter_set
from anagrove.plans import lifecycle
from anagrove.session import scratch_name, scratch_path
from anagrove.sinks import tables
from anagrove.sinks.export import read_latest_export


def states(spark, n=400):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        word = "".join(rng.choices("abcdef", k=5)) + "abcdef"[i % 6]
        label = None if i >= n * 3 // 4 else float(rng.random() < 0.4)
        seen = None if label is None else dt.date(2024, 1, 1 + i % 28)
        rows.append((word, seen, float(10 ** rng.uniform(0, 4)), [rng.gauss(0, 1) for _ in range(6)], label, "B"))
    schema = "word string, last_seen_on date, frequency double, embedding array<float>, label float, batch_id string"
    df = spark.createDataFrame(rows, schema).dropDuplicates(["word"])
    return with_letter_set(df).cache()


def test_train_score_publish_export(spark):
    db = scratch_name("life")
    tables.create_db(spark, db, scratch_path(spark, db))
    current = states(spark)
    bands = hybrid.default_bands(max_iter=20, trees=3, depth=3)
    model = lifecycle.train_on_states(current, 3, bands)
    for _ in range(2):
        stored = lifecycle.publish_probabilities(current, model, db, "B", 1)
        assert stored.count() == current.count()
    truth = stored.filter("source = 'truth'")
    assert truth.filter("model_version IS NOT NULL").isEmpty()
    labels = current.select("word", "label").filter("label IS NOT NULL")
    assert truth.join(labels, "word").filter(F.col("probability") == F.col("label")).count() == labels.count()
    scored = stored.filter("source = 'model'")
    assert scored.filter("probability BETWEEN 0 AND 1 AND model_version = 1").count() == scored.count() > 0

    root = scratch_path(spark, "export")
    lifecycle.export_probabilities(stored, root, dt.date(2024, 2, 1))
    lifecycle.export_probabilities(stored.limit(3), root, dt.date(2024, 2, 1))
    with pytest.raises(ValueError, match="before the latest"):
        lifecycle.export_probabilities(stored, root, dt.date(2024, 1, 31))
    lifecycle.export_probabilities(stored, root, dt.date(2024, 2, 2))
    merged = {}
    for line in read_latest_export(spark, root).collect():
        assert ": " not in line.value
        merged.update(json.loads(line.value))
    assert sum(len(v) for v in merged.values()) == current.count()
    assert all(row["letters"] == key and set(row) == {"word", "prob", "date", "letters"} for key, v in merged.items() for row in v)
