"""strata: indicator analytics as plain Spark DataFrame operators.

Sub-packages
------------
functions   Column -> Column helpers (safe casts, bands, keys).
operators   DataFrame -> DataFrame operators (stage, joins, rollups, windows,
            profiles, features, model scoring).
sources     landed-payload readers, table catalogue and sinks.
plans       the reference models composed from operators, and the query
            registry run against the driver's test tables.
streaming   incremental landing of payload files with Structured Streaming.
"""

__version__ = "0.1.0"
