"""Spare-parts inventory ageing and AP-to-GL reconciliation as Spark DataFrame operators.

Layers follow the usual medallion flow:

* ``sources``   -- explicit source schemas, extract readers, bronze landing, test fixtures
* ``operators`` -- silver dimensions/facts, the gold ageing table, reports, reconciliation,
                   persona security, data checks and the data dictionary
* ``functions`` -- reusable column expressions (buckets, movement status, periods, money)
* ``plans``     -- the model (lazy layer wiring), the batch pipeline job, the query registry
                   and the DuckDB oracle SQL
* ``streaming`` -- incremental landing of extract files with Structured Streaming

Every operator is ``DataFrame -> DataFrame``; nothing collects to the driver.
"""

from sparesledger.session import ensure_checkpoint_dir, local_session

__all__ = ["ensure_checkpoint_dir", "local_session"]
