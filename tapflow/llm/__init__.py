"""Training-data operators: each is a ``DataFrame -> DataFrame`` job on Spark.

One module per operator; ``registry`` lists their queries.  Nothing outside
this package imports it (``__spark_entry__`` adds its queries when present).
"""
