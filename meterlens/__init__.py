"""Building-energy analytics as plain ``DataFrame -> DataFrame`` functions on Spark."""
