"""Operators of a training-data pipeline: scoring, packing, sharding, cleaning and de-duplication of documents.

Each module is one operator; `queries` binds them to the test tables. Nothing outside this folder imports it.
"""
