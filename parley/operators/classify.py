"""Binary text classification: prepare labelled text, train, choose the better
of two settings by accuracy on the given validation split, evaluate, save.

The original fine-tunes a transformer adapter on one machine; here the same
data flow runs on ``pyspark.ml`` stages (distributed fitting, no Python
worker): RegexTokenizer -> CountVectorizer -> multinomial NaiveBayes, whose
probabilities follow from token counts.  ``logistic_pipeline`` is the
alternative with hashed TF-IDF features and logistic regression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import CLASSIFIER_LENGTH, SEED
from ..functions.text import TOKEN_SPLIT
from .encode import build_vocabulary, encode_fixed
from .prepare import drop_rename, shuffle_take, shuffled, split_train_val_test

# Two settings, after the two runs of the original: here more vs less smoothing.
SETTINGS = [{"smoothing": 1.0}, {"smoothing": 0.1}]
MAX_VOCABULARY = 1 << 20  # tokens a model knows, the most frequent first


def labelled_splits(labelled: DataFrame, keys: Sequence[str] = ("idx",), seed: int = SEED) -> DataFrame:
    """Train / val / test split of a labelled table (exact sizes, seeded)."""
    return split_train_val_test(labelled, keys, seed)


def prepare_labelled(labelled: DataFrame, n_train: int | None = None,
                     n_valid: int | None = None, length: int = CLASSIFIER_LENGTH,
                     seed: int = SEED, text_col: str = "sentence", label_col: str = "label",
                     key: str = "idx") -> DataFrame:
    """CLS-1: the shuffled train and val splits (or their first ``n_train`` /
    ``n_valid`` rows), encoded to ``length`` ids with a vocabulary of the
    train part; text and key dropped, label renamed to ``labels``.
    ``shuffle_pos`` is the place in the seeded order of the split.

    Output ``(split, shuffle_pos, input_ids, attention_mask, labels)``.
    """
    sp = labelled_splits(labelled, [key], seed)
    part = lambda name, n: (shuffled(sp.where(F.col("split") == name), seed, [key]) if n is None
                            else shuffle_take(sp.where(F.col("split") == name), n, seed, [key]))
    tr, va = part("train", n_train), part("val", n_valid)
    subset = tr.unionByName(va)
    vocab = build_vocabulary(tr, [text_col])
    enc = encode_fixed(subset, vocab, text_col, length, [key], carry=["split", "shuffle_pos", label_col])
    return drop_rename(enc, drop=(text_col, key), rename=(label_col, "labels")).select(
        "split", "shuffle_pos", "input_ids", "attention_mask", "labels")


def text_pipeline(text_col: str = "sentence", label_col: str = "label", smoothing: float = 1.0) -> Pipeline:
    """Token counts and multinomial naive Bayes."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=TOKEN_SPLIT, toLowercase=True)
    counts = CountVectorizer(inputCol="_tokens", outputCol="_features", vocabSize=MAX_VOCABULARY)
    return Pipeline(stages=[tok, counts, NaiveBayes(featuresCol="_features", labelCol=label_col, smoothing=smoothing)])


def logistic_pipeline(text_col: str = "sentence", label_col: str = "label", **lr) -> Pipeline:
    """Hashed TF-IDF features and logistic regression."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=TOKEN_SPLIT, toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=1 << 18)
    idf = IDF(inputCol="_tf", outputCol="_features")
    return Pipeline(stages=[tok, tf, idf, LogisticRegression(featuresCol="_features", labelCol=label_col, **lr)])


def train_text_classifier(train: DataFrame, text_col: str = "sentence", label_col: str = "label",
                          pipeline: Pipeline | None = None, **settings) -> PipelineModel:
    """CLS-2: fit the text pipeline (or a given one)."""
    chosen = pipeline or text_pipeline(text_col, label_col, **{**SETTINGS[0], **settings})
    return chosen.fit(train.withColumn(label_col, F.col(label_col).cast("double")))


def select_best_by_accuracy(train: DataFrame, valid: DataFrame, text_col: str = "sentence", label_col: str = "label",
                            settings: Sequence[dict] = tuple(SETTINGS)) -> tuple[PipelineModel, DataFrame]:
    """CLS-3: fit every setting on ``train`` and score its accuracy on the
    whole given ``valid`` split; the best wins, ties the earlier setting.

    Returns the best model and ``(setting, smoothing, accuracy, chosen)``.
    """
    models = [train_text_classifier(train, text_col, label_col, **s) for s in settings]
    scores = [evaluate_classifier(m, valid, label_col).first()["accuracy"] or 0.0 for m in models]
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    rows = [(i + 1, float(s["smoothing"]), float(a), i == best) for i, (s, a) in enumerate(zip(settings, scores))]
    table = train.sparkSession.createDataFrame(rows, "setting int, smoothing double, accuracy double, chosen boolean")
    return models[best], table


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("idx", "label")) -> DataFrame:
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability").alias("probability"))


def evaluate_classifier(model: PipelineModel, valid: DataFrame, label_col: str = "label") -> DataFrame:
    """CLS-4: accuracy and log-loss (mean of -ln p[label]) on ``valid``."""
    pred = predict(model, valid, keep=(label_col,))
    p_true = F.element_at(F.col("probability"), F.col(label_col).cast("int") + 1)
    return pred.agg(
        F.avg((F.col("prediction") == F.col(label_col)).cast("double")).alias("accuracy"),
        F.avg(-F.log(F.greatest(p_true, F.lit(1e-15)))).alias("log_loss"),
        F.count(F.lit(1)).cast("bigint").alias("rows"))


def save_model(model: PipelineModel, path: str) -> str:
    """CLS-5: persist (overwrite) and return the path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
