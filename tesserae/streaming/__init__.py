"""Checks over streams of pairs, and windows over events."""
