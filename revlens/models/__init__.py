"""Spark ML text classifiers, candidate comparison and scoring."""
