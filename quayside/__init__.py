"""quayside: Spark batch pipelines for point-of-sale and sales data."""
