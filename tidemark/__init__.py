"""tidemark: incremental history (SCD2) and governance operators on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``)
built from native Spark expressions, so Catalyst sees one declarative plan.
"""

__version__ = "0.1.0"
