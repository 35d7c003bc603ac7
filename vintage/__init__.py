"""vintage: compare releases of a record dataset on Spark.

Given several releases (or vendors) of the same data plus official
statistics, the operators here measure how complete each field is, how its
values are distributed, and how both shift between releases and against the
benchmarks. Every operator takes and returns lazy DataFrames; nothing is
collected to the driver.
"""

from vintage.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
