"""seatcast — event-ticket demand and pricing analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, windows, joins and Spark ML stages, so Catalyst plans the work.
"""

__version__ = "0.1.0"
