"""DataFrame → DataFrame building blocks and the composite billing jobs."""
