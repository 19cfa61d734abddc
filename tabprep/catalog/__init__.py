"""Registered queries, one module per section of the inventory."""

from tabprep.catalog import cleaning, images, models, profiling, ranking, sampling, splits, storage, text, trees, vectors  # noqa: F401
