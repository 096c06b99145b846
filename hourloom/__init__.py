"""hourloom: dated, hourly time-series work written as Spark DataFrame plans.

Every function takes DataFrames and returns a DataFrame; nothing is executed
until the caller acts on the result, except where a docstring says otherwise.
Anything that depends on "today" takes an explicit ``as_of`` date.
"""
