"""A PySpark-native analytics engine for research corpora.

Every operator takes DataFrames and column names and returns a DataFrame; nothing is executed
until the caller asks for rows, except where an operator iterates (its docstring says so).
"""

__version__ = "0.1.0"
