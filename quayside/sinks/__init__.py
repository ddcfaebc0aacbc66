"""Where batches land."""
