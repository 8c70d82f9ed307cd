"""Where rows come from and land: contracts, NDJSON, topics and layer tables."""
