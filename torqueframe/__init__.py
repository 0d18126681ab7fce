"""torqueframe — retail and after-sales analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or ``-> Column``)
built from Spark SQL expressions, so Catalyst plans, prunes and distributes
the work. Sub-packages:

* ``functions``  column expressions (text, dates, numeric, classes)
* ``operators``  DataFrame operators (clean, profile, joins, windows, scores,
                 encoding, sampling, selection, metrics, reports, models)
* ``sources``    CSV/Parquet readers and sinks, model and metrics persistence
* ``plans``      compositions of operators into end-to-end jobs
* ``streaming``  (empty: the reference has no streaming operator)
"""

__version__ = "0.1.0"
