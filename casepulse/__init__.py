"""casepulse: case-process indicators as Spark DataFrame plans.

Every operator takes DataFrames and explicit parameters and returns a DataFrame.
Nothing in the package reads the clock, collects rows, or holds state between calls.
"""

__version__ = "0.1.0"
