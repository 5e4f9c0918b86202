"""tapflow: smart-card tap analytics as composable PySpark DataFrame transformations.

Bus rides and metro gate taps are loaded, cleaned, joined to station tables,
merged into one tap table, cut into origin-destination (OD) trips and counted
as passenger flow.  Every step is a ``DataFrame -> DataFrame`` function, so a
caller composes them with ``df.transform`` and Catalyst plans the whole chain.

Sub-packages
------------
``sources``    scans and sinks (delimited files, JDBC, catalog tables) and the
               mapping of the driver's test tables onto the domain tables.
``functions``  column expressions shared by several operators.
``operators``  the cleaning, station-join, merge, OD and flow operators, plus
               the skew-safe helpers used for hot card-days.
``plans``      the named batch steps (table in -> table out) and the query
               registry used by ``__spark_entry__.py``.
"""

from tapflow.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
