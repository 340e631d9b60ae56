"""Writers: series, predictions, comparisons, lists and models."""
