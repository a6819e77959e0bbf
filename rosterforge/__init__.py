"""Entity catalogs on Spark: matching, merging, enrichment and reports over tables of any size."""
