"""vitalmart — a Spark-native rebuild of a small health-statistics warehouse.

Layers (all DataFrame / Spark SQL, no Python UDFs):

* ``sources``   readers and writers (parquet, CSV landing files, page links)
* ``functions`` column expressions (text cleaning, decades, exact means)
* ``operators`` reusable relational building blocks (reshape, keys, joins,
  filters)
* ``plans``     the pipeline: staging -> star schema -> views -> worksheets,
  plus the query catalogue registered in ``__spark_entry__``
"""

__version__ = "0.1.0"
