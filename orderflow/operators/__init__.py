"""DataFrame in, DataFrame out; no operator starts a job."""
