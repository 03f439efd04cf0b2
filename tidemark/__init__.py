"""A Spark engine for time-stamped observation files and gridded fields."""
