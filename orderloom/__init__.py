"""orderloom: a layered order and device warehouse expressed as Spark DataFrames.

Layers: change events and app logs -> dimensions and facts -> wide order lines -> rankings and dashboards.
Every operator is a plain ``DataFrame -> DataFrame`` function, used unchanged by batch queries and by
``foreachBatch`` in the streaming jobs.
"""
