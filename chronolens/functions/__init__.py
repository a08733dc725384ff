"""chronolens.functions."""
