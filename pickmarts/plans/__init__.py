"""Plans that tie the jobs together: the mart registry, the full run, and the
driver-table queries."""
