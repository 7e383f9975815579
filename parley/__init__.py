"""parley: support-text analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark's own
expressions, windows, joins, Structured Streaming and ML stages.

Sub-packages
------------
``sources``    readers, writers and the corpus stand-ins over the driver tables
``functions``  column helpers: hashing order, exact ranks, text, lexicons
``operators``  prepare / profile / bank / respond / encode / evaluate / classify
``streaming``  chat answering and keyed history on Structured Streaming
``plans``      named query plans over the tables, and their SQL oracles
"""

__version__ = "0.1.0"
