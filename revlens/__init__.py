"""revlens: customer-review analytics as lazy Spark DataFrame operators.

Sub-packages
------------
sources    readers, writers, catalog helpers and the test-data stand-in views
functions  column expressions (sentiment mapping, text normalisation, hashing)
operators  ``DataFrame -> DataFrame`` operators (cleaning, profiling, bias,
           sampling, text features, naive Bayes)
models     Spark ML candidates, leaderboard and scoring
plans      the reference's SQL statements and end-to-end flows
streaming  Structured Streaming scoring
"""

__version__ = "0.1.0"
