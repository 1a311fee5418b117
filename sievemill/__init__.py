"""Literature-mining and catalog analytics as Spark DataFrame plans."""
