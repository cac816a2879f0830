"""Quality classifier: logistic regression on hashed words and word pairs, trained with FTRL-proximal updates.

Labels come from the training folds alone, and from at most SAMPLE_ROWS rows of least hash; every text is scored
as a sparse dot product.  Scores depend on the text only.  Null and empty texts have the feature "no word" and
get its score; repeated rows get equal scores; without labels every score is 0.5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.linear import Model, class_share, for_share, labelled_sample, ngram_features, sample_features, scored, train_ftrl

FOLD, FOLDS = 1, 3


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", fold: int = FOLD, folds: int = FOLDS) -> Model:
    _, y, rows = sample_features(labelled_sample(docs, labels, label, fold, folds, text=text), ngram_features, once=False)
    return for_share(train_ftrl(rows, y, alpha=3.0, l1=0.003, l2=0.003), y, class_share(labels, label, fold, folds))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", fold: int = FOLD, folds: int = FOLDS, names: tuple[str, str, str] = ("score", "predicted", "held_out")) -> DataFrame:
    """Append score (0 to 1, label 1 likelier the higher), predicted and held_out to docs, under `names`.

    Columns of docs that have these names give way.  An empty table stays empty; without labels every score is 1/2.
    """
    return scored(docs, fit_quality(docs, labels, label, text, fold, folds), ngram_features, text, fold, folds, 0.5, names)


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "held_out", "score", "predicted")
