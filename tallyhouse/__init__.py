"""Warehouse operators on the PySpark DataFrame API.

``functions``  column expressions, ``operators``  DataFrame -> DataFrame,
``sources`` / ``sinks``  reading and writing, ``streaming``  repeatable ingest,
``plans``  whole jobs, reports and the query registry.
"""
