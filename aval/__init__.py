"""Aval: applicant scoring expressed as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function meant for ``df.transform``; nothing
here materialises data on the driver except learned parameters whose size is bounded by the
number of columns, classes, models or segments.
"""
