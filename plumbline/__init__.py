"""Population reference distributions and corpus preparation as Spark plans."""
