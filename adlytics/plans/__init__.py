"""The reports: finance, install-fraud screens and marketing funnels."""
