"""Clickstream analytics expressed as Spark DataFrame operators.

Every operator takes and returns DataFrames; no module creates a session or
keeps global state.  ``plans`` composes the operators into whole jobs and
``jobs`` holds the ``spark-submit`` entry points.
"""
