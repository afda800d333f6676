"""reportkit: business-reporting operators as Spark DataFrame programs.

Every public function maps DataFrames to a DataFrame and only composes the
DataFrame / SQL API, so Catalyst plans it and executors run it.
"""

__version__ = "0.1.0"
