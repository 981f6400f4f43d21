"""Star-schema loads and real-time feeds for a delivery business, on Spark DataFrames.

Importing the package starts nothing: every function takes DataFrames or a
session from the caller. Dates are read in the session time zone; set
``spark.sql.session.timeZone`` to UTC for results that do not move with the cluster.
"""
