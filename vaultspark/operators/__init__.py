"""DataFrame operators. Lazy, side-effect free, no driver-side data."""
