from revspark.plans.job import JobOutputs, build_outputs, rank_enriched, run_job, write_outputs
from revspark.plans.process import process_reviews, process_reviews_by_ratio

__all__ = [
    "JobOutputs",
    "build_outputs",
    "process_reviews",
    "process_reviews_by_ratio",
    "rank_enriched",
    "run_job",
    "write_outputs",
]
