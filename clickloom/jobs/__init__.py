"""``spark-submit`` entry points, one module per job."""
