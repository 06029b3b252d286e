"""Whole flows: bronze views, the two pipelines, the bronze-to-silver job."""
