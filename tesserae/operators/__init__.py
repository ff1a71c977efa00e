"""Operators over keyed text tables."""
