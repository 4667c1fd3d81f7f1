"""Complete jobs: the bound tables, the end-to-end flows and the query catalog."""
