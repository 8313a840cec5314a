"""DataFrame -> DataFrame building blocks; column names are arguments."""
