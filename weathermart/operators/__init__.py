"""Layer transformations: ``DataFrame -> DataFrame``, no I/O."""
