"""Whole jobs, composed of sources and operators."""
