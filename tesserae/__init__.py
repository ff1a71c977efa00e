"""Tesserae: keyed-text quality, reconciliation and rewriting as Spark DataFrame plans."""
