"""Training-data operators: filters, dedup, tokens and archives for text tables.

One module per operator; `queries` registers one query per operator.  Nothing
outside this folder imports it.
"""
