"""postsift: a Spark-native posting-qualification and run-telemetry engine.

Every public operator takes and returns DataFrames (or Columns). The core
never calls ``collect`` on data, never uses a Python UDF, and never reads the
clock inside a query: run dates and run ids are parameters.

Layout
------
``functions``  Column -> Column helpers (text cleanup, URLs, rule compilation)
``operators``  DataFrame -> DataFrame operators (scoring, leads, telemetry,
               evaluation, session state, page extraction, ordering)
``sources``    table bindings, schemas, file sources and sinks
``plans``      the registered queries and their SQL oracles
``streaming``  Structured Streaming variants of scoring, dedupe and health
"""

__version__ = "0.1.0"
