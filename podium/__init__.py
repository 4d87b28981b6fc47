"""podium: ranking and comparing the entities of a yearly panel on Spark."""
