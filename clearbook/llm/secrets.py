"""Secret scans: candidates by pattern, false positives removed by a random forest.

All of it is DataFrame and SQL functions, and Spark's own random forest.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A candidate: 16 letters, digits or signs of encodings in a row, with a digit among them.
RUN = "[A-Za-z0-9_+/=-]{16,}"
CANDIDATE = f"(?=[A-Za-z_+/=-]*[0-9]){RUN}"
NAMES = "(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer)"
EXAMPLES = "(?i)(test|example|sample|mock|dummy|fixture|docs?)"
FEATURES = [
    "length", "distinct_share", "digit_share", "upper_share", "lower_share", "sign_share", "letter_to_digit", "digit_to_letter",
    "case_changes", "sign_changes", "repeats", "dictionary_share", "path_depth", "path_is_example", "names_before", "assigned",
    "quoted", "word_before_length", "word_after_length", "after_in_quotes",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Each candidate with its document, place among the words, the words around it and the document's path.

    Every match in every whole text, in order; of a null or empty text none.
    A null path counts as empty. Rows of equal id and text have the same findings,
    each. Documents without a digit or a long run are left out before they are cut into words.
    """
    table = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("_text"),
        F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"),
    ).where(F.col("_text").rlike("[0-9]") & F.col("_text").rlike(RUN))
    words = table.select("doc_id", "path", F.split("_text", "\\s+").alias("_words"))
    wide = words.select("doc_id", "path", "_words", F.posexplode("_words").alias("word_at", "_word")).where(
        (F.length("_word") >= 16) & F.col("_word").rlike("[0-9]") & F.col("_word").rlike(CANDIDATE)
    )

    def near(step: int) -> Column:
        return F.coalesce(F.get("_words", F.col("word_at") + step), F.lit(""))

    around = wide.select(
        "doc_id", "path", "word_at", "_word", near(-2).alias("before2"), near(-1).alias("before"), near(1).alias("after"),
        F.posexplode(F.regexp_extract_all("_word", F.lit(f"({CANDIDATE})"), F.lit(1))).alias("match_at", "candidate"),
    )
    return around.withColumn("lead", F.expr("substring(_word, 1, instr(_word, candidate) - 1)")).withColumn(
        "trail", F.expr("substring(_word, instr(_word, candidate) + length(candidate))")
    ).drop("_word")


def _count(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)).cast("double")


def dictionary(spark: SparkSession, vocabulary_path: str, least_letters: int = 3) -> DataFrame:
    """Whole words of a fixed public vocabulary (a tokenizer's JSON file, read by the driver)."""
    with open(vocabulary_path, encoding="utf-8") as source:
        vocabulary = json.load(source)["model"]["vocab"]
    whole = sorted({w.removesuffix("</w>") for w in vocabulary if w.endswith("</w>")})
    words = [(w,) for w in whole if len(w) >= least_letters and w.isascii() and w.isalpha()]
    return spark.createDataFrame(words, "dictionary_word string")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with the numbers the forest decides by. ``words`` is the dictionary.

    Dictionary coverage is the share of a candidate's characters in runs of letters
    that are words; runs are joined with the dictionary by distinct candidate.
    """
    runs = F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("([a-z]{3,})"), F.lit(1)))
    spelled = found.select("candidate").distinct().select("candidate", runs.alias("dictionary_word"))
    covered = spelled.join(words, "dictionary_word").groupBy("candidate").agg(F.sum(F.length("dictionary_word")).alias("_covered"))
    size = F.length("candidate").cast("double")
    letters = F.split("candidate", "")
    name_before = F.concat_ws(" ", "before2", "before", "lead")
    values = {
        "length": size,
        "distinct_share": F.size(F.array_distinct(letters)) / size,
        "digit_share": _count("[0-9]") / size,
        "upper_share": _count("[A-Z]") / size,
        "lower_share": _count("[a-z]") / size,
        "sign_share": _count("[_+/=-]") / size,
        "letter_to_digit": _count("[A-Za-z](?=[0-9])") / size,
        "digit_to_letter": _count("[0-9](?=[A-Za-z])") / size,
        "case_changes": _count("[a-z](?=[A-Z])|[A-Z](?=[a-z])") / size,
        "sign_changes": _count("[A-Za-z0-9](?=[_+/=-])") / size,
        "repeats": _count("(.)(?=\\1)") / size,
        "dictionary_share": F.coalesce("_covered", F.lit(0)) / size,
        "path_depth": F.regexp_count("path", F.lit("/")),
        "path_is_example": F.col("path").rlike(EXAMPLES),
        "names_before": name_before.rlike(NAMES),
        "assigned": name_before.rlike("[=:]"),
        "quoted": F.col("lead").rlike("[\"'`]$") & F.col("trail").rlike("^[\"'`]"),
        "word_before_length": F.length("before"),
        "word_after_length": F.length("after"),
        "after_in_quotes": F.col("after").rlike("[\"'`]"),
    }
    joined = found.join(covered, "candidate", "left")
    return joined.withColumns({name: value.cast("double") for name, value in values.items()}).drop("_covered")


def _label() -> Column:
    """One for a secret, zero for none, null where the rule can't tell."""
    name = F.concat_ws(" ", "before2", "before", "lead").rlike(NAMES)
    quoted = F.col("lead").rlike("[\"'`]$") & F.col("trail").rlike("^[\"'`]")
    assigned = F.concat_ws(" ", "before2", "before", "lead").rlike("[=:]")
    number = F.col("candidate").rlike("^[0-9-]+$")
    label = F.when(name & quoted & assigned & ~number, 1.0).when(number | ~(name | quoted | assigned), 0.0)
    return label


def labelled_by_rule(found: DataFrame) -> DataFrame:
    """Findings that a narrow rule can tell for sure, as ``label``; the others are left out.

    A quoted value assigned to a credential's name is a secret; a plain number, or
    a value neither assigned nor quoted nor near such a name, is none.
    """
    return found.withColumn("label", _label()).where(F.col("label").isNotNull())


def scan_by_rule(found: DataFrame) -> DataFrame:
    """As ``scan``, by the rule alone, where too few labels are there for a forest; what it can't tell counts as a secret."""
    secret = F.coalesce(_label() == 1.0, F.lit(True)).alias("is_secret")
    return found.select("doc_id", "word_at", "match_at", "candidate", F.lit(None).cast("double").alias("probability"), secret)


def train(labelled: DataFrame, words: DataFrame, per_label: int = 5000, trees: int = 20, seed: int = 7) -> PipelineModel | None:
    """A random forest on a bounded sample: the ``per_label`` findings of each label with the smallest hash.

    None if there are no findings of both labels.
    """
    order = F.xxhash64("candidate", "doc_id", "word_at", "match_at")
    chosen = None
    for label in (0.0, 1.0):
        part = labelled.where(F.col("label") == label).orderBy(order, "candidate", "doc_id", "word_at", "match_at").limit(per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = features(chosen, words).select("label", *FEATURES)
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=8, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(sample)


def scan(found: DataFrame, words: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Each finding with the forest's probability that it is a secret, and whether that is over one half.

    Without a model the probability is null and every candidate counts as a secret.
    """
    columns = ["doc_id", "word_at", "match_at", "candidate"]
    if model is None:
        return found.select(*columns, F.lit(None).cast("double").alias("probability"), F.lit(True).alias("is_secret"))
    scored = model.transform(features(found, words))
    return scored.select(*columns, F.get(vector_to_array("probability"), F.lit(1)).alias("probability")).withColumn(
        "is_secret", F.col("probability") > 0.5
    )
