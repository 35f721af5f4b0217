"""Demand analytics on sales-order lines, written as Spark DataFrame jobs."""
