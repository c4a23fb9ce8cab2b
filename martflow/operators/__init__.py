"""DataFrame-to-DataFrame operators. Nothing here collects rows to the driver."""
