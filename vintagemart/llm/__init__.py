"""Operators of a training-data pipeline, one module each.

Every module holds one operator with its own interface; ``queries`` applies each
of them to its whole table.  Functions that run inside tasks are imported by the
Python workers, so the package has to be installed wherever executors run.
"""
