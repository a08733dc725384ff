"""chronolens.streaming."""
