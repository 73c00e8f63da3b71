"""Commerce analytics on Spark: marketplace exports in, metric tables out.

Every metric is a function of DataFrames that returns a lazy DataFrame.
"""
