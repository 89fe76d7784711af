"""A retail inventory ledger on Spark: running book stock, count adjustments and age of stock."""
