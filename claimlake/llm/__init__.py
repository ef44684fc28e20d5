"""Operators for text corpora on the way to training data.

Nothing else in the library imports this package. Every operator takes a frame
and column names and returns a frame with the columns it names; other columns of
its input are not carried, so their names cannot clash with anything here.
"""
