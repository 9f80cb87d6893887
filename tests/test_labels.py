"""Labels that are not numbers 0..K-1, weighted multi-class models, causal oracle of weights."""

import pytest
from pyspark.sql import functions as F

from lifetab.operators import models


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(240).select("id", *[(((F.col("id") * k) % 17) / 17).alias(c) for c, k in (("a", 3), ("b", 5))]) \
        .withColumn("g", (F.col("a") > 0.5).cast("int"))


@pytest.mark.parametrize("kind", ["string", "numbers"])
def test_coded_labels(rows, kind):
    names = {"string": ("no", "yes"), "numbers": (1, 2)}[kind]
    df = rows.withColumn("y", F.when(F.col("g") == 1, names[1]).otherwise(names[0]))
    model, met = models.train_and_evaluate(df, "id", "y", ["a", "b"])
    assert min(r["value"] for r in met.collect() if r["metric"] in ("auroc", "auprc")) > 0.9
    out = models.predict(model, df, "y")
    assert out.where(F.col("predicted_label") != F.col("y").cast("string")).count() < 24
    assert models.predict(model, df.withColumn("y", F.lit(None).cast(df.schema["y"].dataType)), "y").where("label is not null").count() == 0


def test_plain_labels_stay(rows):
    assert models.label_classes(rows, "g") is None
    assert models.label_classes(rows.withColumn("y", F.col("g") + 9), "y") == ["9", "10"]


def test_unmapped_parameter_raises():
    with pytest.raises(ValueError, match="sampling_strategy"):
        models.make_classifier("balanced_rf", {"sampling_strategy": "auto"})
