"""Domain compositions: staging, fact loads, views, data products and report tables."""
