"""chronolens.plans."""
