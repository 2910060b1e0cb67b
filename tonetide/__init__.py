"""Tone analytics over news feeds, written as Spark DataFrame jobs.

The package is layered the way a plan is read:

* ``functions``  Column in, Column out
* ``sources``    feed lines, vocabulary lists, result tables
* ``operators``  DataFrame in, DataFrame out
* ``plans``      whole jobs built from the operators
"""
