"""DataFrame operators: one input frame (or two) in, one frame out."""
