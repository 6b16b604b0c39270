"""Company-statement and share-price analytics as Spark DataFrame operators."""
