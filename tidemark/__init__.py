"""Feature engineering for lines, grids and scenes, as Spark DataFrame transformations."""
