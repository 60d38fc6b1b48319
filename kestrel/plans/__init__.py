"""Query catalogue: fixture views, parsed tables and registered queries."""
