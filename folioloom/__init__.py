"""Folioloom: Spark jobs for incremental web-content pipelines.

Every operator takes DataFrames and returns a DataFrame; nothing is executed
until the caller writes or collects.  See ``README.md`` for the tour.
"""

__version__ = "0.1.0"
