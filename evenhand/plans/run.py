"""A whole detection run."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.lexicons import DEFAULT_LEXICONS, Lexicons
from evenhand.operators import corpus as C
from evenhand.operators import counterfactual as X
from evenhand.operators.detection import annotate, explode_findings
from evenhand.operators.preparation import detect_language, preprocess
from evenhand.operators.shared import settled
from evenhand.options import DEFAULT_OPTIONS, DetectOptions


@dataclass
class Run:
    """Lazy tables of one detection run (or of many, told apart by ``by``).

    ``annotated`` holds one narrow row per text with its findings and is kept in memory and
    on disk, since every other table derives from it; a lost executor only means that its
    part is computed again.
    """

    annotated: DataFrame
    findings: DataFrame
    metrics: DataFrame
    demographic: dict[str, DataFrame] = field(default_factory=dict)
    linguistic: dict[str, DataFrame] = field(default_factory=dict)
    counterfactual: DataFrame | None = None
    recommendations: DataFrame | None = None

    def unpersist(self) -> None:
        self.annotated.unpersist()


def detect(texts: DataFrame, lexicons: Lexicons = DEFAULT_LEXICONS,
           options: DetectOptions = DEFAULT_OPTIONS, by: tuple = (),
           include_demographic: bool = True, include_linguistic: bool = True,
           include_counterfactual: bool = True, counterfactual_texts: int | None = None,
           persist: bool = True, pick=X.hash_pick) -> Run:
    """Preprocess, identify languages, detect, aggregate.

    ``texts`` has ``doc_id`` and ``text``; ``output`` (a model's answer) is what is searched
    if present, else the text itself; a ``language`` column is used if present.
    """
    prepared = preprocess(texts, options)
    if "language" not in prepared.columns:
        prepared = detect_language(prepared, lexicons)
    if "model_name" not in prepared.columns:
        prepared = prepared.withColumn("model_name", F.lit(options.model_name))
    searched = prepared
    if "output" in prepared.columns:
        searched = prepared.drop("text").withColumnRenamed("output", "text")
    annotated = annotate(searched, None, lexicons, options, by_automaton=True)
    if persist:
        annotated = annotated.persist(StorageLevel.MEMORY_AND_DISK)

    findings = explode_findings(annotated)
    # The same for those who read the metrics and for the advice, so that texts are searched once for both.
    metrics = settled(C.run_metrics(annotated, by))
    run = Run(annotated, findings, metrics)
    if include_demographic and "demographic" in options.checks:
        run.demographic = C.demographic_analysis(
            findings, C.total_samples(annotated, by), options, by)
    if include_linguistic and "linguistic" in options.checks:
        run.linguistic = C.linguistic_analysis(prepared, lexicons, by=by)
    if include_counterfactual:
        run.counterfactual = X.counterfactual_differences(
            prepared, texts=counterfactual_texts, by=by, pick=pick)
    run.recommendations = C.recommendations(
        metrics, run.linguistic.get("sentiment_disparities"), by)
    return run
