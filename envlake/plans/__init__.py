"""The named jobs: sources -> fact or dimension table."""

from envlake.plans.air import air_fact
from envlake.plans.collector import collect_observations, requested_documents
from envlake.plans.runner import JOBS, JobSpec, run, written_previews
from envlake.plans.weather import weather_fact

__all__ = [
    "JOBS",
    "JobSpec",
    "air_fact",
    "collect_observations",
    "requested_documents",
    "run",
    "weather_fact",
    "written_previews",
]
