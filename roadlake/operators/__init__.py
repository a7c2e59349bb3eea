"""DataFrame -> DataFrame operators: normalise, clean, curate, quality."""

from roadlake.operators import clean, curate, normalize, quality

__all__ = ["clean", "curate", "normalize", "quality"]
