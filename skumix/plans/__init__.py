"""Composed plans: model sweeps, the segmentation run, the query catalog."""
