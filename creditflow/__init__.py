"""Credit-risk features, binning and scoring as Spark jobs."""
