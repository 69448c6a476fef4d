"""Footfall: app-event log analytics as PySpark DataFrame operators.

``functions``  column expressions (text, days, places)
``operators``  DataFrame -> DataFrame building blocks
``sources``    table scans, sinks and staging
``plans``      the daily jobs, wired from the operators
"""
