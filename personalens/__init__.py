"""personalens: persona gap analytics on Spark.

Compares the customer personas found in reviews with the personas that
advertising targets. Every operator is a DataFrame -> DataFrame function
built from Spark's own expressions, so Catalyst plans a whole report at once.
"""

__version__ = "0.1.0"
