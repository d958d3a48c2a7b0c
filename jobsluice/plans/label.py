"""One labelling run over a job table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from jobsluice.operators.enrich import Classifier, attach_labels, enrich_resume
from jobsluice.operators.filters import pending_rows


def label_jobs(
    jobs: DataFrame, classify: Classifier, work_path: str, key: str = "url", rounds: int | None = None,
    prompt_chars: int | None = None, **flags: bool,
) -> DataFrame:
    """Label the pending records in restartable rounds and write the results back."""
    results = enrich_resume(pending_rows(jobs, **flags), classify, work_path, key, rounds, prompt_chars=prompt_chars)
    return attach_labels(jobs, results, key)
