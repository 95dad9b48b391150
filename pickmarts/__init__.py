"""pickmarts: warehouse pick analytics as Spark jobs.

Layers: raw CSV -> staging (typed Parquet) -> curation (star schema with
order picks, pick errors and returns, calendar and product dimensions) ->
data marts (KPI tables). Every job is a function from DataFrames to a
DataFrame; writing is separate (``pickmarts.sources.layers``).
"""

__version__ = "0.1.0"
