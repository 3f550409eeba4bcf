"""Spark jobs that turn raw environmental measurements into long fact tables."""

from envlake.plans.runner import run

__all__ = ["run"]
