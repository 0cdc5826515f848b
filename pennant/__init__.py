"""Season analytics on Spark: who did what, in which period, for which group."""
