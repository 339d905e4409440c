"""beaconry: incident analytics as Spark DataFrame jobs.

Raw delimited files are landed under a fixed schema, cleaned and typed,
resolved against conformed dimensions into a fact table, and rolled up to a
daily table with control limits.  Query builders, measures, forecasts and
quality checks sit on top.  Every function takes and returns DataFrames or
Columns, so Catalyst plans the whole job.
"""
