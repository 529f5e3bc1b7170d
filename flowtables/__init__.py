"""flowtables: medallion-style business data flows as plain Spark DataFrames.

Transformations are pure functions from DataFrame to DataFrame built from Spark's own
expressions; writing happens only in ``sinks``, ``streaming`` and the jobs in ``plans``.
"""

__version__ = "0.1.0"
