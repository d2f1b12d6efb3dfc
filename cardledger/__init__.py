"""Card-loyalty back office on Spark: five partner feeds, three ledgers.

Every operator is a function from DataFrames to a DataFrame; only
``operators.ledgers`` and the sinks in ``operators.outputs`` write.
"""
