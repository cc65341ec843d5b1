"""DataFrame operators: first-wins merging, resolution, upserts, constraints, matching."""
