"""Change-feed tables on Spark: landing JSON -> raw history -> current state."""
