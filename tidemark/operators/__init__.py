"""DataFrame transformations, by subject."""
