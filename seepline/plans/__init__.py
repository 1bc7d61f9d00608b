"""Whole jobs, composed of the operators. Each returns one lazy plan."""
