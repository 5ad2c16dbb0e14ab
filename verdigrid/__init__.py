"""verdigrid: pixel tables, station series and counterfactual regression on Spark DataFrames."""

from verdigrid.meta import GridMeta

__all__ = ["GridMeta"]
