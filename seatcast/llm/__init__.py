"""Training-data operators on Spark: packing, quality scoring, exact top-k
search, HTML extraction, near-duplicate search, document fingerprints, source
mixing, sharding, token files and language ID.  Nothing outside this
subpackage imports it."""
