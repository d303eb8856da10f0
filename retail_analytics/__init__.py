"""Commercial analytics on Spark: DataFrame operators over a distributor's star schema."""
