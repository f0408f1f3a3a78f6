"""Review-warehouse analytics on Spark: cleaning, star-schema loads, views and reports."""
