"""Bronze, silver and gold models, reports on them, and the gated build."""
