"""tidewater: document and lakehouse data jobs on plain PySpark.

Every public function maps DataFrames to DataFrames (or writes a DataFrame and returns the
written location), so Catalyst sees one declarative plan per job.
"""

__version__ = "0.1.0"
