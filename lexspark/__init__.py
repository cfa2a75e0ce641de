"""lexspark: example sentences and word usage for large corpora, as Spark jobs."""
