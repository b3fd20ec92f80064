"""DataFrame -> DataFrame operators of the four jobs."""
