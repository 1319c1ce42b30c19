"""revspark: review analytics as Spark DataFrame plans.

Layout: ``functions`` (Column expressions), ``operators`` (DataFrame -> DataFrame),
``sources`` (readers, sinks, table adapter), ``plans`` (the composed jobs), ``streaming``
(the same plans on streaming DataFrames).
"""

__version__ = "0.1.0"
