"""How work is spread over the cluster: hot-key splitting and running aggregates."""
