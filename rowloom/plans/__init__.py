"""Transforms, marts, and the run that ties them together."""
