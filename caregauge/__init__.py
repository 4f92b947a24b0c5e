"""Clinical quality measures as lazy Spark DataFrame plans."""
