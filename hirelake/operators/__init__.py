"""DataFrame -> DataFrame steps of the pipeline and the serving analytics."""
