"""Operators of a training-data pipeline (see README, "Training data").

Nothing else in the library imports this subpackage. Every operator reads
only the columns it is told to read; further columns of its input, whatever
their names, are ignored unless its docstring says that it keeps them.
"""
