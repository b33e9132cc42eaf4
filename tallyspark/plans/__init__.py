"""Named queries (one per reference capability) and their SQL oracle texts."""
