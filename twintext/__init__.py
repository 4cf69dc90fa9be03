"""Parallel-text preparation and scoring on Spark DataFrames."""

from twintext.params import SPLITS, PrepParams, special_tokens

__all__ = ["PrepParams", "special_tokens", "SPLITS"]
