"""Operators of a training-data pipeline over document tables.

Each module holds one operator. Nothing else in the library imports this
package; ``queries.py`` registers the ``opN_`` queries.
"""
