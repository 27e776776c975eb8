"""Set-based operators over state, sitemaps, attempts, runs and articles."""
