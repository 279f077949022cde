"""Opinion analytics on Spark: lazy DataFrame operators from raw posts to published aggregates."""
