"""Comment analytics on Spark: ingest, clean, features, views, sinks, quality report."""

from threadsift.plans.job import JobOptions, JobResult, run_job
from threadsift.spec import DEFAULT, FeedSpec

__all__ = ["DEFAULT", "FeedSpec", "JobOptions", "JobResult", "run_job"]
