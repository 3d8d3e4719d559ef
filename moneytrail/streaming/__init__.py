"""Snapshot refresh: fingerprints, rebuild sets, cycle guard, and availableNow file landing."""
