"""Operators for preparing large training corpora.

Nothing else in the package imports this subpackage.  Every operator takes and
returns DataFrames; Python inside a task only ever sees bounded Arrow batches
or bounded groups, and everything that grows with the corpus moves through
Spark's shuffles or through tables in the shared checkpoint folder.
"""
