"""Campaign and recommendation analytics on Spark DataFrames.

Sub-packages:

* ``sources``    – readers and writers (test-data adapter, CSV ingest, result files)
* ``functions``  – column-expression builders (cleaning, typing, text tokens)
* ``operators``  – reusable DataFrame operators (modelling, graph edges,
                   data-quality checks, join helpers)
* ``plans``      – the analyses: campaign conversion (Q1), friend-based
                   recommendation (Q2), keyword search (Q3), timing statistics
* ``streaming``  – incremental (micro-batch) loading with upserts
"""

from socialcart.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
