"""DataFrame-to-DataFrame operators shared by the batch and streaming jobs."""
