"""DataFrame → DataFrame operators of the listings pipeline."""
