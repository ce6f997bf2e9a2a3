"""kestrel: a Spark-native feature-quality, model-evaluation and scoring toolkit.

Every operator takes a DataFrame plus column names and returns a DataFrame
(or a small fitted-state object whose state is itself a DataFrame).  Fitting
is a distributed aggregation; transforming is a projection with the fitted
constants as literals or a broadcast join of a bounded table.
"""

__version__ = "0.1.0"
