"""chronolens.sources."""
