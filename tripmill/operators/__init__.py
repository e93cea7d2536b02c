"""DataFrame -> DataFrame transformations. None of them starts a job."""
