"""riskframe: credit-risk feature building, data-quality profiling,
association statistics and model evaluation as Spark DataFrame operators.

Sub-packages: ``sources`` (scans and sinks), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame operators), ``plans``
(registered queries over the test tables, with their SQL oracles) and
``streaming`` (incremental scoring)."""

__version__ = "0.1.0"
