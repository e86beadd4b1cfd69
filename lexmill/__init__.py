"""lexmill: linguistic annotation of very large text collections as plain Spark plans."""

from lexmill.plans.annotate import annotate, annotate_with_model, ranked_results, run_job
from lexmill.plans.catalogue import resolve, validate

__all__ = ["annotate", "annotate_with_model", "ranked_results", "resolve", "run_job", "validate"]
