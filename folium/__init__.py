"""Document analytics on Spark: typed tables of pages, blocks, portions and bundles, and operators over them."""
