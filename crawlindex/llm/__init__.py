"""Operators a training-data pipeline needs, on the tables of documents, pages
and vectors. Nothing else in the library imports this subpackage."""
