"""Curation of source-code and text corpora as Spark DataFrames."""

from corpuslens.operators.rules import (
    TIERS,
    Thresholds,
    cascade,
    cascade_text,
    kept_only,
    kept_text,
    tier,
)
from corpuslens.plans.curate import LanguageChoice, curate, label_corpus
from corpuslens.plans.extract import extract

__all__ = [
    "TIERS",
    "LanguageChoice",
    "Thresholds",
    "cascade",
    "cascade_text",
    "curate",
    "extract",
    "kept_only",
    "kept_text",
    "label_corpus",
    "tier",
]
