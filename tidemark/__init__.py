"""Point-in-time order analytics expressed as Spark DataFrame work."""
