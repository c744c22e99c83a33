"""Operators of a training-data pipeline over text corpora.

Nothing else in the library imports this subpackage; ``registry`` lists its
queries. Python code here runs inside Spark tasks on Arrow batches.
"""
