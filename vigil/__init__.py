"""vigil — data-quality, text-feature, model-quality and monitoring operators on Spark DataFrames.

Every operator takes DataFrames plus column names and returns a DataFrame; the
driver only ever collects one-row reports or bounded helper tables (quotas,
bucket boundaries) whose size is fixed by a parameter, never by the data.
"""

__version__ = "0.1.0"
