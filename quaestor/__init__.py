"""quaestor — tax-administration warehouse analytics on the public PySpark API.

Every operator is a DataFrame-in / DataFrame-out function parameterised by
column names.  Sub-packages:

* ``functions``  Column -> Column helpers (strings, dates, fiscal calendars,
  money and ratios, codes and bands, identifiers, hashing, JSON).
* ``sources``    scans, writers, run logs and merges into target tables.
* ``operators``  mapping, joins, keys, aggregates, windows, set operations,
  slowly changing dimensions, hierarchies, ledgers, data quality.
* ``plans``      warehouse builders (dimensions, facts, snapshots), domain
  analytics, form jobs and the binding to the driver test tables.
* ``streaming``  Structured Streaming forms of the incremental loads.
"""

from quaestor.session import get_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
