"""DataFrame operators: ``DataFrame -> DataFrame``, lazy, nothing collected."""
