"""DataFrame-to-DataFrame operators of the event pipeline."""
