"""skein: career statistics for competition and activity records on Spark.

``functions`` (Column expressions), ``operators`` (DataFrame -> DataFrame), ``sources``
(readers, writers, page extraction), ``plans`` (composite jobs and registered queries).
"""

__version__ = "0.1.0"
