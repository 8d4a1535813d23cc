"""Operator compositions: the layered pipeline, the model lifecycle, bound queries."""
