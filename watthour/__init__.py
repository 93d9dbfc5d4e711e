"""Hourly series features, day-ahead forecasts and drift monitoring on Spark.

Every operator is a plain function from DataFrame to DataFrame.  Columns default
to ``date_time`` for the event time and ``ac_power`` for the reading; ``keys``
names the columns that tell series apart (none = one single series).
"""
