"""Operators for preparing large text corpora.

Each module holds one operator with a general DataFrame interface;
``queries`` binds them to the tables of the query contract.
"""
