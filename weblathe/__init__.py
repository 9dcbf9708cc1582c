"""weblathe: web-resolution log analytics as Spark DataFrame plans."""
