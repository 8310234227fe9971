"""tidemark: financial-text and market-signal analytics as Spark DataFrame jobs.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function. Dates (``as_of``, ``now``), thresholds and lexicons are explicit
arguments so the same plan runs in tests, in batch jobs and inside
Structured Streaming ``foreachBatch`` bodies.
"""

__version__ = "0.1.0"
