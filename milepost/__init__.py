"""Activity and loyalty-points analytics written as Spark DataFrame functions."""
