"""Complete jobs: inputs in, gated output out."""
