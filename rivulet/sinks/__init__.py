"""Writers (K). A sink for streams is a function of (DataFrame, batch id)."""
