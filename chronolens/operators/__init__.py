"""chronolens.operators."""
