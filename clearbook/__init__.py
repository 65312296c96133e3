"""Settlement and reconciliation analytics for an interoperable payment hub.

Every operator is a plain function from DataFrames to a DataFrame.
"""
