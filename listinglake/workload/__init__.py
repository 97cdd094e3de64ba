"""The operators and jobs, run over the given star-schema tables.

The tables hold no property listings, so listings, rates and landed responses are
derived from them by Spark.  Every query comes with the SQL that computes the same
rows directly from the tables, where SQL can.
"""
