"""Turn text corpora into shuffled, fixed-length training shards with Spark."""
