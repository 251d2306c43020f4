"""Split-test (A/B/n) analytics on Spark DataFrames."""

from splitmetrics.config import ExperimentConfig
from splitmetrics.operators.population import Population
from splitmetrics.plans.pipeline import InputTables, RawEvents, RunResult, run

__all__ = ["ExperimentConfig", "InputTables", "Population", "RawEvents", "RunResult", "run"]
