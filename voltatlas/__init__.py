"""Geospatial and charging-network analytics as Spark jobs.

``functions``  Column expressions (no actions, no Python workers)
``sources``    readers for features, cubes, candidates, responses, envelopes
``operators``  DataFrame -> DataFrame work: ranking, joins, de-duplication, gates
``plans``      whole jobs assembled from the operators
``streaming``  envelope consumers
``sinks``      writers
``queries``    the operators run on the driver tables, each with its SQL check
"""
