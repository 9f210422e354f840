"""Training-data operators: one module per operator, queries in `queries.py`.

Every operator takes a DataFrame and the names of its id and text columns, reads only
those, and returns columns of its own, so other columns of the input never clash.
A null text counts as an empty one; the modules say what else is defined for edge cases.
"""
