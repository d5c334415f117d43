"""quietfare: privacy-safe sharing of trip-style records as Spark plans."""
