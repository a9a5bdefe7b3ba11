"""Transport punctuality analytics on Spark DataFrames."""

from ontime.params import RunParams, run_params

__all__ = ["RunParams", "run_params"]
