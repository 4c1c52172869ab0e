"""Plans: the query catalog, the full sync run and its atomic publish."""
